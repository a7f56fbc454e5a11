"""Plain-Python versions of the corpus operators, and odd inputs."""

import hashlib
import re
from collections import Counter, defaultdict

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def low_words(text):
    return words((text or "").translate(LOWER))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


#: (doc_id, text): nulls, empty and long texts, repeated rows, ids that
#: stand for several texts.
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000)) + "\nthe end of it"
ODD_DOCS = [
    (1, None), (2, ""), (3, " \t \n "), (4, "one two"), (5, LONG), (6, LONG), (7, "A line that repeats\nx"),
    (8, "a LINE that repeats \ny"), (None, "a line that repeats\nwithout id"), (None, None), (9, "same row here twice"),
    (9, "same row here twice"), (10, "first text of ten"), (10, "second text of ten"), (11, "é€\U0001f600 \x0b z"),
]


def docs_frame(spark, rows=ODD_DOCS, extra=True):
    """Documents with columns whose names clash with internal ones."""
    kinds = "doc_id bigint, text string"
    data = [tuple(r) for r in rows]
    if extra:
        kinds += ", source string, row string, kept boolean, n_words string, h1 int, node string, `a.b` int, size string"
        data = [(*r, None if i % 3 == 0 else f"s{i % 2}", "r", None, "x", i, None, 1, "z") for i, r in enumerate(data)]
    return spark.createDataFrame(data, kinds).repartition(3)


def repeat_words(w):
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    return len({j for p in at.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)})


def base_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n, r = len(w), repeat_words(w)
    return (n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, r,
            n < 50 or 100 * r > 50 * n)


def line_dedup(docs):
    """Kept lines of each row of [(doc_id, text)]; null ids come last."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, rank(i)), rank(i))
    return [[x for x in (t or "").split("\n") if len(key(x)) < 10 or first[key(x)] == rank(i)] for i, t in docs]


def shingle_set(text):
    w = low_words(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def groups(sets):
    """The component number of each set under J >= 3/4 (by all pairs that
    share a shingle)."""
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    both = Counter((b, a) for rows in holders.values() for a in rows for b in rows if b < a)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in both.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            root[find(a)] = find(b)
    return [find(i) for i in range(len(sets))]


def leaking_items(text, items, window=13, allowed=2):
    """Ids of items of which a window stands in the text, at most ``allowed``
    words replaced (short items: as a whole, unchanged)."""
    w, out = low_words(text), set()
    for item, t in items:
        x = low_words(t)
        size, miss = min(window, len(x)), allowed if len(x) >= window else 0
        for d in range(-len(x) + 1, len(w)) if x else []:
            same = [0 <= d + j < len(w) and w[d + j] == x[j] for j in range(len(x))]
            if any(sum(same[s:s + size]) >= size - miss for s in range(len(x) - size + 1)):
                out.add(item)
                break
    return out


def repeated_bytes(texts, size=100):
    """For each text (bytes, in order): which bytes a string of ``size``
    bytes that also starts earlier covers."""
    seen, out = set(), []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i:i + size]
            if s in seen:
                gone[i:i + size] = b"\1" * size
            seen.add(s)
        out.append(gone)
    return out
