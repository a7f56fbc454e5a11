"""Plain-Python reference formulas, written from the definitions (used as
test oracles on small inputs)."""

from __future__ import annotations

import math
from collections import defaultdict


def columns(triples):
    col = defaultdict(dict)
    for u, i, r in triples:
        col[i][u] = float(r)
    return col


def rows(triples):
    row = defaultdict(dict)
    for u, i, r in triples:
        row[u][i] = float(r)
    return row


def _cos(a, b):
    na = math.sqrt(sum(v * v for v in a.values()))
    nb = math.sqrt(sum(v * v for v in b.values()))
    dot = sum(a[u] * b[u] for u in a if u in b)
    return dot / (na * nb)


def item_sims(triples, measure):
    """All-pairs item similarity; zero-norm items dropped (None for pairs)."""
    col = columns(triples)
    if measure == "adjusted_cosine":
        rw = rows(triples)
        mean = {u: sum(v.values()) / len(v) for u, v in rw.items()}
        col = {i: {u: r - mean[u] for u, r in c.items()} for i, c in col.items()}
    elif measure == "pearson":
        col = {i: {u: r - sum(c.values()) / len(c) for u, r in c.items()} for i, c in col.items()}
    col = {i: c for i, c in col.items() if math.sqrt(sum(v * v for v in c.values())) > 1e-12}
    items = sorted(col)
    return {(a, b): _cos(col[a], col[b]) for a in items for b in items if a < b}, items


def neighbour_lists(triples, measure, k):
    sims, items = item_sims(triples, measure)
    out = {}
    for i in items:
        cand = [(sims[(min(i, j), max(i, j))], j) for j in items if j != i]
        cand.sort(key=lambda t: (round(t[0], 9), t[1]), reverse=True)
        out[i] = cand[:k]
    return out


def l1(a, b):
    keys = set(a) | set(b)
    return sum(abs(a.get(x, 0.0) - b.get(x, 0.0)) for x in keys)


def agreement(a, b):
    keys = set(a) | set(b)
    if not keys:
        return 1.0
    return sum(5.0 - abs(a[x] - b[x]) for x in set(a) & set(b)) / len(keys)
