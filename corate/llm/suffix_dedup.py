"""Operator 9: removal of repeated 100-byte strings by a difference cover.

A byte goes if some 100-byte string that covers it also starts earlier
(smaller document, or earlier in the same one). Equality of prefixes of 100
bytes is all that matters, so the difference-cover suffix array is built to
that depth:

* ``COVER`` is a difference cover modulo 57: for any two places i, j some
  shift d < 57 makes both i + d and j + d sampled. Equal 100-byte strings
  therefore share, at a sampled place, the tuple of the following 44 bytes.
* Sampled tuples are *named* and sorted: a name is a 64-bit fingerprint
  (the recursion on names is the prefix hashing that builds the fingerprint;
  order among unequal tuples is never needed). Sorted by (name, context,
  place), equal suffixes are neighbours.
* The remaining suffixes are merged through their shift to a sampled place:
  all 57 windows around a sampled place depend on its *context* (the 56
  bytes before and the 100 from it on). A place whose name and context occur
  earlier has all its windows repeated. Only names with several contexts
  need more: there the windows of the first place of each context are
  compared shift by shift.

Two exact reductions come first. Whole texts that are copies keep only the
first one. And only regions around a repeated *minimizer* (smallest 44-byte
hash among 57 consecutive ones, a property of the content) are sampled:
equal 100-byte strings have the same minimizer, so nothing outside such a
region is repeated.

Every step is a shuffle by hash and a sorted stream; no group is held in
memory except the contexts of one name, and names with more than
``HOT_NAME`` contexts are compared by a distributed aggregation of their
windows instead. Equality is decided on 64-bit name and 64-bit context
together, and shift by shift within a name on 64 bits.

Defined results: a null text is empty; texts below 100 bytes lose nothing.
Equal rows: all but one lose everything. If doc_ids are null or stand for
several texts, texts are ordered by (doc_id with null last, hash of text).
An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import table, text_of
from corate.llm.textscan import U, build_filter, chunks, in_filter, mix, signed
from corate.operators.indexing import dense_index
from corate.session import materialize

LENGTH = 100
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)  # differences give every residue mod 57 (fixed values)
GRAM = LENGTH - PERIOD + 1
HOT_NAME = 100_000
COPY_BROADCAST_ROWS = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_pow: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_pow.get(base, ())) < n:
        x = np.full(max(n, 1 << 21), base, U)
        x[0] = 1
        _pow[base] = np.multiply.accumulate(x)
    return _pow[base][:n]


def _prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * _powers(_BASE, len(data)), out=out[1:])
    return out


def _substring(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int) -> np.ndarray:
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(prefix))
    return mix((prefix[hi] - prefix[lo]) * inverse[lo], seed)


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (minimum or maximum) over every run of ``width`` values."""
    out, size = x, 1
    while size * 2 <= width:
        out = least(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return least(out[:len(out) - rest], out[rest:]) if rest else out


def minimizers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a chunk of texts, and hashes, of the 44-byte strings that
    are smallest among the 57 of some 100-byte string of one text."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, U)
    prefix = _prefix(data)
    at = np.arange(n - GRAM + 1)
    h = _substring(prefix, at, at + GRAM, 1)
    end = np.repeat(offsets[1:], np.diff(offsets))  # of the text of each byte
    h[end[:len(h)] < at + GRAM] = ~U(0)
    low = _sliding(h, PERIOD, np.minimum)
    low[end[:len(low)] < np.arange(len(low)) + LENGTH] = 0  # not within one text
    pad = np.zeros(PERIOD - 1, U)
    picked = np.flatnonzero((h == _sliding(np.r_[pad, low, pad], PERIOD, np.maximum)) & (h != 0))
    return picked, h[picked]


def _minimizer_rows(batches):
    """(h, doc, at, known). Of places with the same minimizer in a batch one
    is given with its h; the others are known to be repeated and are given
    under a key of their own, so that a hot minimizer spreads."""
    for b in batches:
        docs = b.column(0).to_numpy(zero_copy_only=False)
        parts = []
        for first, data, offsets in chunks(b.column(1)):
            at, h = minimizers(data, offsets)
            text = np.searchsorted(offsets, at, "right") - 1
            parts.append((h, docs[first + text], at - offsets[text]))
        if not parts:
            continue
        h, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, one, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        known = count[back] > 1
        own = _own_key(doc, at)
        # the one of each h, and every repeated place
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(np.r_[h[one], own[known]])), pa.array(np.r_[doc[one], doc[known]]),
             pa.array(np.r_[at[one], at[known]]), pa.array(np.arange(len(one) + known.sum()) >= len(one))],
            ["h", "doc", "at", "known"])


def _own_key(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(doc.astype(np.int64).view(U) * U(0x9FB21C651E98DF25) + at.astype(U), 9)


def _repeated(batches):
    """(doc, at) of known rows, and of rows, sorted by h, whose h occurs at
    least twice among the others."""
    last, given = None, False
    for b in batches:
        known = b.column(3).to_numpy(zero_copy_only=False)
        h, doc, at = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if known.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[known]), pa.array(at[known])], ["doc", "at"])
            h, doc, at = h[~known], doc[~known], at[~known]
        if not len(h):
            continue
        if last is not None:
            h, doc, at = np.r_[last[0], h], np.r_[last[1], doc], np.r_[last[2], at]
        same = h[1:] == h[:-1]
        out = np.r_[False, same] | np.r_[same, False]
        if last is not None and given:
            out[0] = False
        last = (h[-1], doc[-1], at[-1])
        given = bool(out[-1]) or (len(h) == 1 and given)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[out]), pa.array(at[out])], ["doc", "at"])


def _text_bytes(batch: pa.RecordBatch, column: int):
    """The bytes of each text of a batch as numpy arrays."""
    for _, data, offsets in chunks(batch.column(column)):
        for i in range(len(offsets) - 1):
            yield data[offsets[i]:offsets[i + 1]]


def _sampled(n: int, marks: np.ndarray) -> np.ndarray:
    """Sampled places of a text of ``n`` bytes inside the regions of ``marks``."""
    edge = np.zeros(n + 2, np.int64)
    np.add.at(edge, np.maximum(marks - PERIOD + 1, 0), 1)
    np.add.at(edge, np.minimum(marks + LENGTH, n) - GRAM + 1, -1)  # no tuple starts later
    inside = np.cumsum(edge[:n]) > 0
    p = np.flatnonzero(inside)
    return p[np.isin(p % PERIOD, COVER)]


def _sample_rows(batches):
    """(name, context, doc, at, full) of the sampled places in repeated
    regions. Of places of a batch with the same name and context the first
    one is given with its name; the others have an earlier equal (``full``)
    and are given under keys of their own, so that hot names spread."""
    for b in batches:
        docs = b.column(0).to_numpy(zero_copy_only=False)
        marks = b.column(2)
        out, held = [], 0
        for i, data in enumerate(_text_bytes(b, 1)):
            p = _sampled(len(data), marks[i].values.to_numpy(zero_copy_only=False))
            prefix = _prefix(data)
            lo, hi = np.maximum(p - PERIOD + 1, 0), np.minimum(p + LENGTH, len(data))
            shape = ((p - lo) * 1000 + (hi - p)).astype(U)  # cut off by the text's ends
            name = _substring(prefix, p, p + GRAM, 2)
            context = mix(_substring(prefix, lo, hi, 3) + shape * U(0xD6E8FEB86659FD93))
            out.append((signed(name), signed(context), np.full(len(p), docs[i], np.int64), p))
            held += len(p)
            if held > 500_000:
                yield _first_places(out)
                out, held = [], 0
        if out:
            yield _first_places(out)


def _first_places(parts) -> pa.RecordBatch:
    name, context, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((at, doc, context, name))
    name, context, doc, at = name[order], context[order], doc[order], at[order]
    full = np.r_[False, (name[1:] == name[:-1]) & (context[1:] == context[:-1])][:len(name)]
    name = np.where(full, signed(_own_key(doc, at)), name)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (name, context, doc, at, full)],
                                      ["name", "context", "doc", "at", "full"])


def _neighbours(batches):
    """From rows sorted by (name, context, doc, at): (name, doc, at, full).

    Rows known to be full are passed on. ``full``: an earlier place has the same name and context. Other rows
    given out are the first places of each context of names with several.
    State between batches: the last row, and whether it was given out.
    """
    last, pending, several = None, None, False
    for b in batches:
        known = b.column(4).to_numpy(zero_copy_only=False)
        if known.any():
            yield b.filter(pa.array(known)).select(["name", "doc", "at", "full"])
            b = b.filter(pa.array(~known))
        name, ctx, doc, at = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        n = len(name)
        if not n:
            continue
        before = (np.r_[name[0], name[:-1]], np.r_[ctx[0], ctx[:-1]])
        same_name = name == before[0]
        same = same_name & (ctx == before[1])
        same_name[0] = last is not None and name[0] == last[0]
        same[0] = same_name[0] and ctx[0] == last[1]
        first = ~same  # first places of a context
        # a name has several contexts if a first place continues the name
        idx = np.flatnonzero(first)
        k_name = name[idx]
        goes_on = same_name[idx]  # a later context of its name
        begins_several = np.r_[k_name[1:] == k_name[:-1], False] if len(idx) else np.zeros(0, bool)
        give = goes_on | (~goes_on & begins_several)
        edge_rows = idx[give]
        parts = [(name[same], doc[same], at[same], np.ones(int(same.sum()), bool)),
                 (name[edge_rows], doc[edge_rows], at[edge_rows], np.zeros(len(edge_rows), bool))]
        if pending is not None and len(idx) and goes_on[0]:
            # the first context seen of this name waited in an earlier batch
            parts.append(tuple(np.array([x]) for x in (*pending, False)))
            pending = None
        elif pending is not None and (not same_name[0] or (~same_name).any()):
            pending = None
        if len(idx) and not goes_on[-1] and not give[-1]:
            pending = (name[idx[-1]], doc[idx[-1]], at[idx[-1]])
        last = (name[-1], ctx[-1])
        out = [np.concatenate(x) for x in zip(*parts, strict=True)]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["name", "doc", "at", "full"])


def _context_rows(batches):
    """(name, doc, at, before, context bytes) for each wanted place."""
    for b in batches:
        docs = b.column(0).to_numpy(zero_copy_only=False)
        wanted = b.column(2)
        out = [[], [], [], [], []]
        for i, data in enumerate(_text_bytes(b, 1)):
            got = wanted[i].values
            raw = data.tobytes()
            for name, p in zip(got.field(0).to_pylist(), got.field(1).to_pylist(), strict=True):
                lo = max(p - PERIOD + 1, 0)
                for col, x in zip(out, (name, int(docs[i]), p, p - lo, raw[lo:p + LENGTH]), strict=True):
                    col.append(x)
            if len(out[0]) > 20_000:
                yield _context_batch(out)
                out = [[], [], [], [], []]
        if out[0]:
            yield _context_batch(out)


def _context_batch(out) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                                      ["name", "doc", "at", "before", "bytes"])


def _window_hashes(before: np.ndarray, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per row and shift d (the window starts d bytes before the place): the
    window's hash, and whether the window lies in the text."""
    size = np.array([len(x) for x in blobs])
    width = PERIOD - 1 + LENGTH
    data = np.zeros((len(blobs), width), np.uint8)
    for i, x in enumerate(blobs):  # aligned so that the place is at PERIOD - 1
        data[i, PERIOD - 1 - before[i]:PERIOD - 1 - before[i] + len(x)] = np.frombuffer(x, np.uint8)
    prefix = np.zeros((len(blobs), width + 1), U)
    np.cumsum((data.astype(U) + U(1)) * _powers(_BASE, width), axis=1, out=prefix[:, 1:])
    d = np.arange(PERIOD)
    lo = PERIOD - 1 - d
    inverse = _powers(pow(_BASE, -1, 1 << 64), width + 1)
    h = mix((prefix[:, lo + LENGTH] - prefix[:, lo]) * inverse[lo])
    ok = (d <= before[:, None]) & ((size - before)[:, None] - LENGTH >= -d)
    return h, ok


def _compare_windows(batches):
    """Spans (doc, lo, hi) of windows that occur earlier under the same name,
    from rows sorted by (name, doc, at)."""
    held: list[pa.RecordBatch] = []

    def spans(rows: pa.Table):
        name = rows.column(0).to_numpy().view(U)
        doc, at, before = (rows.column(i).to_numpy() for i in (1, 2, 3))
        h, ok = _window_hashes(before, rows.column(4).to_pylist())
        d = np.arange(PERIOD).astype(U)
        key = mix(h + mix(name)[:, None] + d * U(0x9FB21C651E98DF25))
        r, c = np.nonzero(ok)
        _, first = np.unique(key[r, c], return_index=True)  # rows are in order of place
        late = ok.copy()
        late[r[first], c[first]] = False
        # runs of shifts of a row are runs of window starts
        edge = np.diff(np.pad(late, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, lo_d = np.nonzero(edge == 1)
        _, hi_d = np.nonzero(edge == -1)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[row]), pa.array(at[row] - (hi_d - 1)), pa.array(at[row] - lo_d + LENGTH)],
            ["doc", "lo", "hi"])

    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        name = b.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(np.r_[True, name[1:] != name[:-1]])[-1])
        if cut or (held and held[-1].column(0)[-1].as_py() != int(name[0])):
            if cut:
                held.append(b.slice(0, cut))
            for part in _pieces(pa.Table.from_batches(held)):
                yield spans(part)
            held, size = [b.slice(cut)], b.num_rows - cut
        else:
            held.append(b)
            size += b.num_rows
    if held:
        for part in _pieces(pa.Table.from_batches(held)):
            yield spans(part)


def _pieces(rows: pa.Table, target: int = 20_000):
    """Whole names, about ``target`` rows at a time."""
    rows = rows.combine_chunks()
    name = rows.column(0).to_numpy()
    starts = np.r_[np.flatnonzero(np.r_[True, name[1:] != name[:-1]]), len(name)]
    lo = 0
    for i, s in enumerate(starts[1:], 1):
        if s - lo >= target or i == len(starts) - 1:
            yield rows.slice(lo, s - lo)
            lo = int(s)


def _window_rows(batches):
    """(h1, doc, start) of every window of hot names, for the aggregation."""
    for b in batches:
        name = b.column(0).to_numpy(zero_copy_only=False).view(U)
        doc, at, before = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        blobs = b.column(4).to_pylist()
        for s in range(0, len(blobs), 5000):
            e = s + 5000
            h, ok = _window_hashes(before[s:e], blobs[s:e])
            r, c = np.nonzero(ok)
            key = mix(h + mix(name[s:e])[:, None] + np.arange(PERIOD).astype(U) * U(0x9FB21C651E98DF25))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key[r, c])), pa.array(doc[s:e][r]), pa.array(at[s:e][r] - c)],
                ["key", "doc", "start"])


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.r_[True, lo[1:] > hi[:-1]]
    return lo[new], hi[np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]]


def _cut(batches):
    """(doc, spans, kept bytes) of documents with spans."""
    for b in batches:
        out = []
        for i, data in enumerate(_text_bytes(b, 1)):
            s = b.column(2)[i].values
            lo, hi = merge_spans(s.field(0).to_numpy(zero_copy_only=False), s.field(1).to_numpy(zero_copy_only=False))
            keep = np.r_[0, hi], np.r_[lo, len(data)]
            out.append((b.column(0)[i].as_py(),
                        [{"start": int(x), "end": int(y)} for x, y in zip(lo, hi, strict=True)],
                        b"".join(data[x:y].tobytes() for x, y in zip(*keep, strict=True))))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], spans),
             pa.array([x[2] for x in out], pa.binary())], ["doc", "spans", "kept"])


def _by_hash(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key, *order)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(doc, spans, kept)`` of distinct texts ``(doc, text)`` with unique,
    ordered non-null long ids: the maximal repeated byte runs and the
    remaining bytes, for each document that has any."""
    marks = (_by_hash(docs.mapInArrow(_minimizer_rows, "h bigint, doc bigint, at bigint, known boolean"), "h")
             .mapInArrow(_repeated, "doc bigint, at bigint"))
    marks = materialize(marks.groupBy("doc").agg(F.collect_list("at").alias("marks")), "repeat-marks")
    regional = materialize(_among(docs, marks).join(marks, "doc").select("doc", "text", "marks"), "regional-texts")

    samples = regional.mapInArrow(_sample_rows, "name bigint, context bigint, doc bigint, at bigint, full boolean")
    near = materialize(_by_hash(samples, "name", "context", "doc", "at")
                       .mapInArrow(_neighbours, "name bigint, doc bigint, at bigint, full boolean"), "neighbours")
    edges = near.where("NOT full").groupBy("doc").agg(F.collect_list(F.struct("name", "at")).alias("places"))
    contexts = (regional.select("doc", "text").join(edges, "doc").select("doc", "text", "places")
                .mapInArrow(_context_rows, "name bigint, doc bigint, at bigint, before bigint, bytes binary"))
    hot = materialize(near.where("NOT full").groupBy("name").count().where(F.col("count") > HOT_NAME)
                      .select("name"), "hot-names")
    kinds = "doc bigint, lo bigint, hi bigint"
    cold = contexts
    late = None
    if not hot.isEmpty():
        contexts = materialize(contexts, "contexts")
        cold = contexts.join(hot, "name", "left_anti")
        windows = materialize(contexts.join(hot, "name", "left_semi")
                              .mapInArrow(_window_rows, "key bigint, doc bigint, start bigint"), "hot-windows")
        firsts = windows.groupBy("key").agg(F.min(F.struct("doc", "start")).alias("first"))
        late = (windows.join(firsts, "key").where("first.doc <> doc OR first.start <> start")
                .select("doc", F.col("start").alias("lo"), (F.col("start") + LENGTH).alias("hi")))
    spans = _by_hash(cold.select("name", "doc", "at", "before", "bytes"), "name", "doc", "at") \
        .mapInArrow(_compare_windows, kinds)
    if late is not None:
        spans = spans.unionByName(late)
    size = regional.select("doc", F.octet_length("text").alias("n"))
    full = (near.where("full").join(size, "doc")
            .select("doc", F.greatest(F.col("at") - (PERIOD - 1), F.lit(0)).alias("lo"),
                    (F.least(F.col("at"), F.col("n") - LENGTH) + LENGTH).alias("hi"))
            .where(f"hi - lo >= {LENGTH}"))
    found = (spans.unionByName(full).groupBy("doc")
             .agg(F.collect_list(F.struct("lo", "hi")).alias("s")))
    return (regional.select("doc", "text").join(found, "doc").select("doc", "text", "s")
            .mapInArrow(_cut, "doc bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"))


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose id may be among ``ids``: a filter of fixed size drops
    most others where they are read."""
    bits = docs.sparkSession.sparkContext.broadcast(build_filter(ids, "doc"))

    def run(batches):
        for b in batches:
            ok = in_filter(bits.value, b.column(0).to_numpy(zero_copy_only=False).view(U))
            if ok.any():
                yield b.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)


def _digests(batches):
    """(doc_id, n, h1, h2, sha256) of each text."""
    for b in batches:
        n, h1, h2, sha = [], [], [], []
        for data in _text_bytes(b, 1):
            raw = data.tobytes()
            d = hashlib.sha256(raw).digest()
            n.append(len(raw))
            h1.append(int.from_bytes(d[:8], "little", signed=True))
            h2.append(int.from_bytes(d[8:16], "little", signed=True))
            sha.append(d.hex())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
             pa.array(sha, pa.string())], ["doc_id", "n_bytes", "h1", "h2", "sha256"])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, sha256, spans, kept)`` per row of ``docs``:
    ``spans`` are the removed byte runs, ``kept`` the remaining bytes (null:
    the text itself, whose digest is ``sha256``)."""
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       text_of(F.col(f"`{text_col}`")).alias("text"))
    rows = materialize(docs.mapInArrow(
        _digests, "doc_id bigint, n_bytes bigint, h1 bigint, h2 bigint, sha256 string"), "text-digests")
    # distinct (doc_id, text); the first document of each text holds it
    own = materialize(rows.groupBy("doc_id", "h1", "h2").agg(
        F.count(F.lit(1)).alias("times"), F.first("n_bytes").alias("n_bytes"), F.first("sha256").alias("sha256")),
        "documents")
    null_last = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    holders = own.groupBy("h1", "h2").agg(F.min(null_last).alias("m"), F.count(F.lit(1)).alias("docs"))
    own = materialize(own.join(holders, ["h1", "h2"])
                      .withColumn("copy", ~F.col("doc_id").eqNullSafe(F.col("m.id"))).drop("m"), "held-documents")
    single = own.where("doc_id IS NULL").isEmpty() and \
        own.groupBy("doc_id").count().where("count > 1").isEmpty()
    if single:
        copies = materialize(own.where("copy").select("doc_id"), "copies")
        if copies.count() <= COPY_BROADCAST_ROWS:  # 16 MB; beyond, a plain join
            copies = F.broadcast(copies)
        texts = docs.join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id"]) if _has_repeats(own) \
            else docs.join(copies, "doc_id", "left_anti")
        texts = texts.select(F.col("doc_id").alias("doc"), "text")
        keyed = own.withColumn("doc", F.col("doc_id"))
    else:  # ids are no key: number the texts in order
        order = dense_index(own.where("NOT copy").select(
            F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("none"), "h1", "h2"),
            ["none", "i", "h1", "h2"], id_col="doc")
        keyed = own.join(order.select("h1", "h2", "doc"), ["h1", "h2"])
        hashed = docs.select("text", F.conv(F.substring(F.sha2("text", 256), 1, 16), 16, 10).alias("k"),
                             F.sha2("text", 256).alias("sha256"))
        wanted = keyed.where("NOT copy").select("doc", F.col("sha256").alias("s"))
        texts = (hashed.dropDuplicates(["sha256"]).join(wanted, F.col("sha256") == F.col("s"))
                 .select("doc", "text"))
        texts = materialize(texts, "numbered-texts")
    cut = repeated_spans(texts.where(F.octet_length("text") >= LENGTH))
    cut = materialize(cut, "cut-texts")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    # of equal rows, the first keeps what its text keeps, the others nothing
    row = keyed.join(cut, "doc", "left").withColumn(
        "again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
    gone = (F.col("copy") | (F.col("again") > 1)) & (F.col("n_bytes") >= LENGTH)
    return row.select(
        "doc_id", "n_bytes", "sha256",
        F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def _has_repeats(own: DataFrame) -> bool:
    return not own.where("times > 1").isEmpty()


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, x: acc + x["end"] - x["start"])
    return dedup_bytes(docs).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), F.col("sha256")).alias("kept_sha256"))
