"""Merkle manifest against a plain version."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from corate.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(root, paths): every node's siblings by level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, p in enumerate(paths):
            run, j = runs[at[k] // 3], at[k] % 3
            p.append(("".join(run[:j]), "".join(run[j + 1:])))
            at[k] //= 3
        nodes = [h(*r) for r in runs]
    return nodes[0], paths


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        other = r
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
            other = (*r[:4], r[4].replace("\n", ""))
        groups[r[1]].append((r[0] is not None, r[0] or 0, h(*map(enc, r)), h(*map(enc, other))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort()
        trees[s] = climb([x[2] for x in groups[s]])
    root, top = climb([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, upper in zip(names, top, strict=True):
        sub, paths = trees[s]
        for (known, key, leaf, other), path in zip(groups[s], paths, strict=True):
            path, fold = path + upper, other
            for left, right in path:
                fold = h(left, fold, right)
            out.append((key if known else None, leaf, sub, root, h(*[a + b for a, b in path]), fold, fold == root))
    return out


COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.fixture
def run(spark, tmp_path):
    def go(rows, columns=COLUMNS):
        spark.createDataFrame(rows, columns).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return [tuple(r) for r in merkle.query(spark, str(tmp_path)).collect()]
    return go


def some_rows(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for i, n in enumerate(sizes):
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "é\n", "x", "line\n" * 3])
            rows.append((len(rows), f"s{i}", rng.choice(["en", None]), rng.choice([None, 5]), text))
    rng.shuffle(rows)
    return rows


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [1, 1], [1, 2, 3, 9, 10, 27, 28, 82], [1] * 30])
def test_manifest_matches_plain_version(run, sizes):
    rows = some_rows(sizes)
    assert sorted(run(rows), key=key) == sorted(plain(rows), key=key)


def test_manifest_of_several_tiers(run, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)  # blocks of 9: three tiers for 100 to 700 leaves
    rows = some_rows([1, 81, 82, 730, *[1] * 100])
    assert sorted(run(rows), key=key) == sorted(plain(rows), key=key)


def test_manifest_of_odd_rows(run):
    long = "word\n" * 100_000
    same = (7, "s", "en", 1, "a\nb")
    rows = [same] * 40 + [(7, "s", "en", 1, "other"), (None, None, None, None, None), (None, None, None, None, "x\ny"),
                          (-5, None, "", 0, ""), (9, "", "de", -1, long), (10, "ü", "de", 1, "\n"), (11, "z", None, 2, "\n\n")]
    assert sorted(run(rows), key=key) == sorted(plain(rows), key=key)
    assert run([]) == []
    wide = [(*r, "tree", 3) for r in rows]
    assert sorted(run(wide, COLUMNS + ", payload string, idx int"), key=key) == sorted(plain(rows), key=key)


def test_verification_notices_a_changed_row(run):
    rows = some_rows([50])
    for doc_id, *_, verified in run(rows):
        text = rows[[r[0] for r in rows].index(doc_id)][4]
        changed = zlib.crc32(str(doc_id).encode()) % 2 == 0 and "\n" in (text or "")
        assert verified == (not changed)
