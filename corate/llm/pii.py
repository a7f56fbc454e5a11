"""Operator 5: personal data by weak supervision.

Every text gives candidate spans: the base matches (email, ip, card, phone;
they always stay) and looser ones (numbers that look like cards or phones,
spelled-out emails, secrets behind a key word, social security numbers,
IBANs). Labelers vote on each candidate (+1 personal, -1 not, 0 abstain):

* regex: strict form, checksums, ranges;
* gazetteer: known issuer prefixes, area codes, address ranges, key words;
* context: cue words before the span;
* boundary and variety: stands alone, isn't one repeated character.

Expectation-maximisation (Dawid-Skene with three-valued votes) estimates
each labeler's reliability and each kind's share from the counts of vote
patterns over all candidates: at most kinds x 3^5 rows reach the driver,
however large the corpus. The posteriors are the targets of a logistic
regression on votes and features of the span, fitted on about ``TRAIN_ROWS``
different inputs at most (chosen by a threshold on their hash, weighted by
their candidates), and it scores every candidate.
A candidate becomes a span if its score reaches ``MIN_SCORE`` and it
overlaps no base match.

One pass reads the texts and writes one narrow row per document; scoring is
a projection of it. Regexes run in linear time on any text.

Defined results: a null or empty text has no spans; repeated rows give the
same spans each; an empty table gives an empty table (and no model).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import table, text_of
from corate.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
#: All kinds, in the order of a document's span list.
KINDS = (*BASE_KINDS, "secret", "ssn", "iban")
LABELERS = ("regex", "gazetteer", "context", "boundary", "variety")
TRAIN_ROWS = 20_000
MIN_SCORE = 0.5
EM_ROUNDS = 60

# Cue words and gazetteers.
CUES = {
    "email": "mail email e-mail contact write address", "ip": "ip host server address client addr",
    "card": "card visa mastercard amex credit debit payment", "phone": "call tel phone mobile fax cell telephone",
    "secret": "token key secret password passwd apikey api_key", "ssn": "ssn social security",
    "iban": "iban account bank konto cuenta compte",
}
COUNTER_CUES = "version isbn issn order invoice page figure doi serial part item no number chapter section release"
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35")
TOP_DOMAINS = frozenset("com org net edu gov io co de fr es uk eu info biz us ca it nl ch at".split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63} ?"
                      r"(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}(?![A-Za-z0-9])", re.I)
_SECRET = re.compile(r"(?i)(?:token|secret|password|passwd|api_?key|access_?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
                     r"([A-Za-z0-9+/_-]{12,})")
_SECRET_WORDS = ("token", "secret", "passw", "key")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(digits: str) -> int:
    """The value of a run of digits of any length, 999 for all above that."""
    digits = digits.lstrip("0")
    return int(digits or "0") if len(digits) <= 3 else 999


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``local@domain.tld``, found from each ``@``."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        # the local part: a run of its characters before the @
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1  # an @ ends any run of local characters
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """The base matches by kind, and the failed ones (kind, start, end)."""
    found: dict[str, list[tuple[int, int]]] = {"email": emails(text), "ip": [], "card": [], "phone": []}
    failed = []
    for m in _IP.finditer(text):
        ok = max(map(_small, m[0].split("."))) <= 255
        found["ip"].append(m.span()) if ok else failed.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        n = m.end() - m.start()
        if n < 13:
            continue
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            found["card"].append(m.span())
        elif 13 <= len(d) <= 19:
            failed.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        ok = 8 <= len(_digits(m[0])) <= 15
        found["phone"].append(m.span()) if ok else failed.append(("phone", *m.span()))
    return found, failed


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all candidate spans, without looser ones
    that overlap a base match."""
    found, failed = base_spans(text)
    base = [(k, s, e, True) for k in BASE_KINDS for s, e in found[k]]
    loose = list(failed)
    low = text.lower()
    if " dot " in low or "dot)" in low or "dot]" in low:
        loose += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if any(w in low for w in _SECRET_WORDS):
        loose += [("secret", *m.span(1)) for m in _SECRET.finditer(text)]
    loose += [("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    loose += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    loose += [("iban", *m.span()) for m in _IBAN.finditer(text)]
    taken = sorted((s, e) for _, s, e, _ in base)
    starts = np.array([s for s, _ in taken] or [0])
    ends = np.maximum.accumulate(np.array([e for _, e in taken] or [0]))
    out = []
    for k, s, e in sorted(set(loose), key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        i = int(np.searchsorted(starts, e))  # base matches that begin before e
        if i and ends[i - 1] > s:
            continue
        if out and out[-1][2] > s:  # the looser ones don't overlap each other
            continue
        out.append((k, s, e, False))
    return base + out


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """The labelers' votes on a span: +1 personal, -1 not, 0 abstain."""
    span = text[start:end]
    digits = _digits(span)
    if kind == "email":
        regex = 1 if "@" in span else 0
        gaz = 1 if re.split(r"[. )\]]+", span.lower())[-1] in TOP_DOMAINS else 0
    elif kind == "ip":
        parts = [_small(x) for x in span.split(".")]
        regex = 1 if max(parts) <= 255 else -1
        gaz = -1 if parts[0] in (0, 127, 255) or parts[0] < 10 and parts[1] < 10 and max(parts) < 30 else 1
    elif kind == "card":
        regex = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gaz = 1 if ISSUERS.match(digits) and regex > 0 else (0 if ISSUERS.match(digits) else -1)
    elif kind == "phone":
        regex = 1 if span[0] == "+" and 8 <= len(digits) <= 15 else (-1 if span[0] == "+" else 0)
        area = digits[-10:-7]
        gaz = 1 if len(digits) >= 10 and area[:1] not in ("0", "1") else -1
    elif kind == "secret":
        regex = 1 if any(c.isdigit() for c in span) and any(c.isalpha() for c in span) else -1
        gaz = 1
    elif kind == "ssn":
        bad = digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000"
        regex, gaz = (-1, -1) if bad else (1, 0)
    else:
        regex = 1 if _iban_ok(span) else -1
        gaz = 0
    before = re.findall(r"[a-z_-]+", text[max(0, start - 40):start].lower())[-4:]
    if any(w in CUES[kind].split() for w in before):
        context = 1
    else:
        context = -1 if any(w in COUNTER_CUES.split() for w in before) else 0
    edge = (text[start - 1:start] + text[end:end + 1])
    boundary = -1 if any(c.isalnum() or c == "_" for c in edge) else 1
    chars = digits if kind in ("card", "phone", "ssn") else span
    variety = -1 if len(set(chars)) <= 2 else 1
    return regex, gaz, context, boundary, variety


def features(kind: str, v: tuple[int, ...], length: int, n_digits: int) -> list[float]:
    """Inputs of the classifier: a constant, the kind, each vote's two
    sides, the span's length and share of digits (both in 64 steps, so that
    there are few different inputs, however many candidates)."""
    x = [1.0, *(float(kind == k) for k in KINDS)]
    for y in v:
        x += [float(y > 0), float(y < 0)]
    return [*x, min(length, 64) / 64.0, 64 * n_digits // max(length, 1) / 64.0]


def _scan(batches):
    """One row per text: base counts, base spans, candidates."""
    import hashlib

    for b in batches:
        counts, bases, digests, cands = [], [], [], []
        for text in b.column(1).to_pylist():
            text = text or ""
            got = candidates(text)
            base = [(k, s, e) for k, s, e, is_base in got if is_base]
            counts.append([sum(k == x for x, _, _ in base) for k in BASE_KINDS])
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
            digests.append(hashlib.sha256(joined.encode()).hexdigest())
            rows = []
            for k, s, e, is_base in got:
                v = votes(text, k, s, e)
                rows.append({"kind": KINDS.index(k), "start": s, "end": e, "base": is_base, "votes": list(v),
                             "x": features(k, v, e - s, len(_digits(text[s:e])))})
            cands.append(rows)
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("base", pa.bool_()), ("votes", pa.list_(pa.int32())),
                                   ("x", pa.list_(pa.float64()))]))
        c = np.array(counts, np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(c[:, i]) for i in range(4)], pa.array(digests, pa.string()),
             pa.array(cands, kind)],
            ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "candidates"])


def estimate(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = EM_ROUNDS):
    """Dawid-Skene on counts of (kind, votes): the labelers' vote
    probabilities given the class, the kinds' shares of personal spans, and
    each pattern's posterior."""
    n_labelers = len(LABELERS)
    kind = np.array([p[0] for p in patterns])
    v = np.array([p[1] for p in patterns], int).reshape(-1, n_labelers) + 1  # 0, 1, 2
    count = np.array([p[2] for p in patterns], float)
    # labelers are presumed better than chance: that orients the classes
    table_ = np.stack([np.tile([0.6, 0.3, 0.1], (n_labelers, 1)), np.tile([0.1, 0.3, 0.6], (n_labelers, 1))])
    share = np.full(len(KINDS), 0.5)
    post = np.full(len(kind), 0.5)
    for _ in range(rounds):
        log = np.stack([np.log(table_[y][np.arange(n_labelers), v]).sum(1) for y in (0, 1)])
        log += np.log(np.stack([1 - share[kind], share[kind]]))
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        for y, w in ((0, count * (1 - post)), (1, count * post)):
            for j in range(n_labelers):
                got = np.bincount(v[:, j], w, 3) + (np.array([2, 1, .5]) if y == 0 else np.array([.5, 1, 2]))
                table_[y][j] = got / got.sum()
        for k in range(len(KINDS)):
            w = count[kind == k]
            share[k] = ((w * post[kind == k]).sum() + 1) / (w.sum() + 2)
    return table_, share, post


def fit(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2,
        rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps."""
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - target)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(scanned: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray | None:
    """Weights of the span classifier from the scanned documents.

    Candidates with equal inputs are one training row with their number as
    its weight. If there are more than ``train_rows`` different inputs, those
    with the smallest hashes are taken: the threshold follows from their
    count, so about ``train_rows`` rows reach the driver at any size.
    """
    spans = scanned.select(F.explode("candidates").alias("c"))
    rows = materialize(spans.groupBy("c.kind", "c.votes", "c.x").agg(F.count(F.lit(1)).alias("n")), "pii-inputs")
    counts = rows.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()  # <= kinds * 3^5 rows
    if not counts:
        return None
    counts = sorted((r["kind"], tuple(r["votes"]), r["n"]) for r in counts)
    _, _, post = estimate(counts)
    target = {(k, v): float(p) for (k, v, _), p in zip(counts, post, strict=True)}
    steps = 1 << 30
    part = min(steps, steps * train_rows // rows.count())
    rows = rows.where(F.pmod(F.xxhash64("kind", "votes", "x"), F.lit(steps)) < part).collect()
    rows.sort(key=lambda r: (r["kind"], r["x"]))
    x = np.array([r["x"] for r in rows])
    weight = np.array([r["n"] for r in rows], float)
    return fit(x, np.array([target[r["kind"], tuple(r["votes"])] for r in rows]), weight * len(rows) / weight.sum())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, base counts, ``base_sha256`` and
    ``found``, an array of (kind, start, end, base, score) sorted by kind
    and place (code points, end exclusive)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = materialize(rows.mapInArrow(
        _scan, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
               "candidates array<struct<kind:int,start:bigint,end:bigint,base:boolean,votes:array<int>,"
               "x:array<double>>>"), "pii-candidates")
    w = train(scanned, train_rows)

    def score(x: Column) -> Column:
        if w is None:
            return F.lit(0.0)
        dot = F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, c: a * c),
                          F.lit(0.0), lambda acc, y: acc + y)
        return 1 / (1 + F.exp(-dot))

    scored = F.transform("candidates", lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"),
        score(c["x"]).alias("score")))
    found = F.sort_array(F.filter(scored, lambda c: c["base"] | (c["score"] >= MIN_SCORE)))
    return scanned.select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", found.alias("found"))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_join(F.transform("found", lambda c: F.concat_ws(
        ":", F.get(names, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")
    n = F.size("found").cast("bigint")
    return find(docs).select("doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", spans.alias("spans"),
                             n.alias("n_spans"), (n > 0).alias("has_pii"))
