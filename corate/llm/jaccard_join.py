"""Operator 10: exact n-gram Jaccard self-join by universe partitioning.

Texts become sets of distinct 5-word shingles; sets with a Jaccard
similarity of at least 3/4 link, and the components of the links are
returned. The candidate search loses no link:

* Sizes fall into bands [2^k, 2^(k+1)). A band's scheme hashes the universe
  of shingles into m segments. Two linked sets of sizes s <= r differ in at
  most H = floor((s + floor(4s/3)) / 7) shingles, so if segments get values
  v_i adding up to H + 1, one segment differs by fewer than v_i.
* Every set indexes its non-empty segments under its own band's scheme and,
  if it is small enough in its band to have a smaller partner in the band
  below, under that one too. Some segments are *double*: they also index
  their one-deletion neighbourhood, so they can take v = 2.
* Allocation by cost: a key held by one set only, or only by sets that are
  connected already, costs nothing. If a set's free segments reach H + 1 it
  has no unknown partner; otherwise it probes its cheapest (rarest) keys
  until H + 1 is reached, and its doubles if still needed.
* Pairs are verified exactly on their texts' shingles, after an exact bound
  from 1024 parities of each set has dropped most of the others.
* A probed key with more than ``HOT_KEY`` holders that are still apart (near
  copies just below the threshold, a passage that makes up most of its
  texts) would give each such pair many times. Its holders are compared in
  blocks instead (:func:`_block_links`): only holders outside the largest
  component so far are compared with the others, large groups first lose the
  sets that share too few shingles with the rest, and a task gives out a
  forest over components, never all links.

Groups are never expanded into all pairs: the holders of a key are first
compared with one of them (a star), the verified links are closed to
components, and only keys whose holders lie in different components are
looked at again, by the probes above. Sets so unevenly hashed that even all
values don't reach H + 1 are joined through all their shingles instead.

Nodes are classes of equal sets, named by a 64-bit hash of the set; copies
are dropped before the shuffle where a task sees them. A second hash of each
set tells names that different sets share: such sets take the second hash as
their name, so two sets are one class only if 128 bits agree. Texts are found
by 128 bits too. Equal keys of different segments only cost a verification.

Defined results: a null or empty text, or one without words, has an empty
set, links with nothing and is its own component. Rows sharing a doc_id are
separate texts; a component's id is its smallest non-null doc_id (null if
it has none). An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table, text_of
from corate.llm.components import components
from corate.llm.textscan import (U, build_filter, in_filter, mix, shingle_sets, signed)
from corate.session import materialize

SHINGLE = 5
#: Segments per shingle of a band's largest set, for sets below 32, below 256
#: and above: more segments cost more keys, but leave a set that shares a long
#: passage with many others enough keys of its own to need no probe.
SEGMENTS = ((32, 2.0), (256, 1.0), (None, 0.5))
#: One segment in so many is double (all of them for sets below 32).
DOUBLE_EVERY = 25
#: Probed keys with more holders are compared in blocks of so many sets.
HOT_KEY = 64
BLOCK = 512
#: Sets of a block have about so many shingles at most (the largest set more).
BLOCK_SHINGLES = 1 << 19
#: Bits of a set's parities (128 bytes); a power of two.
PARITY_BITS = 1024
#: Sets hashed together: about so many shingles, and at most so many sets.
RUN_SHINGLES, RUN_SETS = 1 << 17, 512
_PREV, _SINGLE, _DOUBLE = 0, 1, 2  # kinds of keys, in their two lowest bits


def _hashes(flat: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    if not len(n):
        return np.zeros(0, np.int64)
    total = np.add.reduceat(mix(flat, seed), np.cumsum(n) - n)
    return signed(mix(total + n.astype(U), seed + 1))


@dataclass(frozen=True)
class Names:
    """How sets are named: by the upper ``bits`` of a hash, or by a second
    hash where different sets have the same first one (``shared``, sorted;
    about n^2 / 2^65 of n sets)."""

    shared: tuple[int, ...] = ()
    bits: int = 64

    def first(self, flat: np.ndarray, n: np.ndarray) -> np.ndarray:
        return _hashes(flat, n, 5) >> (64 - self.bits)

    def second(self, flat: np.ndarray, n: np.ndarray) -> np.ndarray:
        return _hashes(flat, n, 7)

    def of(self, flat: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The names of non-empty sets, as signed numbers. ``flat`` holds the
        sets' shingles one after another, ``n`` their sizes."""
        name = self.first(flat, n)
        if self.shared:
            twice = np.isin(name, np.array(self.shared, np.int64))
            name[twice] = self.second(flat, n)[twice]
        return name


def _scheme(k: int, segments) -> tuple[int, int]:
    """(number of segments, number of double ones) of band ``k``."""
    top = 2 << k
    m = max(1, int(top * next(x for limit, x in segments if limit is None or top <= limit)))
    return m, m if top <= 32 else -(-m // DOUBLE_EVERY)


def most_different(n: int) -> int:
    return (n + 4 * n // 3) // 7


def _cells(flat: np.ndarray, n: np.ndarray, which: np.ndarray, k: int, segments):
    """Band ``k``'s segments of the sets ``which``: the shingles concerned
    (a mask of ``flat``), the cell of each, the cells' sizes, and which cells
    are double. Cell i * m + j is segment j of the i-th of these sets."""
    m, doubles = _scheme(k, segments)
    at = np.full(len(n), -1)
    at[which] = np.arange(len(which))
    at = np.repeat(at, n)
    mine = at >= 0
    cell = at[mine] * m + ((mix(flat[mine], 11 + k) >> U(32)) * U(m) >> U(32)).astype(np.int64)
    size = np.bincount(cell, minlength=len(which) * m)
    double = (np.arange(len(size)) % m < doubles) & (size >= 2)
    return m, mine, cell, size, double


def _band(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(float))[1] - 1


def keys_of(flat: np.ndarray, n: np.ndarray, segments=SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """The keys of non-empty sets, and for each key the place of its set."""
    band = _band(n)
    below = (band > 0) & (-(-3 * n // 4) < (1 << band))
    part = mix(flat, 12)
    low, high = part & U(0xFFFFFFFF), part >> U(32)
    keys, owners = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for k in np.unique(np.r_[band, band[below] - 1]).tolist():
        which = np.flatnonzero((band == k) | (below & (band == k + 1)))
        m, mine, cell, size, double = _cells(flat, n, which, k, segments)
        # sums of halves are exact as doubles: a cell holds few shingles
        total = np.bincount(cell, low[mine], len(size)).astype(U) \
            + (np.bincount(cell, high[mine], len(size)).astype(U) << U(32))
        name = lambda c, x: mix(x + (c % m).astype(U) * U(0x9FB21C651E98DF25), 100 + k) & ~U(3)  # noqa: E731, B023
        home = band[which] == k
        used = np.flatnonzero(size)
        kind = np.where(double[used], U(_DOUBLE), U(_SINGLE))
        rest = double[cell]
        gone, of = cell[rest], used // m
        keys += [name(used, total[used]) | np.where(home[of], kind, U(_PREV)),
                 name(gone, total[gone] - part[mine][rest]) | np.where(home[gone // m], U(_DOUBLE), U(_PREV))]
        owners += [which[of], which[gone // m]]
    return np.concatenate(keys), np.concatenate(owners)


def values_of(flat: np.ndarray, n: np.ndarray, segments=SEGMENTS) -> np.ndarray:
    """The values that the own keys of each of some non-empty sets add up to."""
    band, out = _band(n), np.zeros(len(n), np.int64)
    for k in np.unique(band).tolist():
        which = np.flatnonzero(band == k)
        m, _, _, size, double = _cells(flat, n, which, k, segments)
        out[which] = ((size > 0) + double.astype(np.int64)).reshape(len(which), m).sum(axis=1)
    return out


def _runs(column):
    """The shingle sets of a column, in lists of bounded length (a very large
    set is a list by itself or the end of one)."""
    sets, held = [], 0
    for _, s in shingle_sets(column, SHINGLE):
        sets.append(s)
        held += len(s)
        if held >= RUN_SHINGLES or len(sets) == RUN_SETS:
            yield sets
            sets, held = [], 0
    if sets:
        yield sets


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.zeros(0, U), *sets]), np.array([len(s) for s in sets], np.int64)


# the same of a single set

def set_keys(s: np.ndarray, segments=SEGMENTS) -> tuple[np.ndarray, int]:
    """The keys of a non-empty set, and the values its own keys add up to."""
    return keys_of(*_flat([s]), segments)[0], set_value(s, segments)


def set_value(s: np.ndarray, segments=SEGMENTS) -> int:
    return int(values_of(*_flat([s]), segments)[0])


def parities(s: np.ndarray) -> np.ndarray:
    return parities_of(*_flat([s]))[0]


def _batch(schema: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x for _, x in schema], [n for n, _ in schema])


def parities_of(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each set the parity of its shingles in each of ``PARITY_BITS``
    classes, as a row of longs.

    A shingle that only one of two sets has changes one bit, so at least as
    many shingles differ as bits do.
    """
    cell = np.repeat(np.arange(len(n)) * PARITY_BITS, n) + (mix(flat, 9) >> U(32)).astype(np.int64) % PARITY_BITS
    odd = np.bincount(cell, minlength=len(n) * PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(n), -1)


def _may_link(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) without those whose parities differ in more bits than
    the shingles of linked sets do: 7 times that exceeds both sizes."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(7 * differ <= F.col("na") + F.col("nb")).select("a", "b")


def _summaries(segments, names: Names):
    def run(batches):
        for b in batches:
            row = 0
            for sets in _runs(b.column(1)):
                flat, n = _flat(sets)
                full = n > 0
                node, second, value = (np.zeros(len(n), np.int64) for _ in range(3))
                node[full], second[full] = names.first(flat, n[full]), names.second(flat, n[full])
                value[full] = values_of(flat, n[full], segments)
                parity = parities_of(flat, n)
                ends = np.arange(len(n) + 1, dtype=np.int32) * parity.shape[1]
                part = b.slice(row, len(n))
                row += len(n)
                yield _batch([("doc_id", part.column(0)), ("version", part.column(2)), ("again", part.column(3)),
                              ("n", pa.array(n)), ("node", pa.array(node, mask=~full)),
                              ("second", pa.array(second)), ("value", pa.array(value)),
                              ("parity", pa.ListArray.from_arrays(pa.array(ends), pa.array(parity.ravel())))])
    return run


def _all_keys(segments, names: Names):
    def run(batches):
        seen: set[int] = set()  # copies within a task give their keys once
        for b in batches:
            for sets in _runs(b.column(0)):
                sets = [s for s in sets if len(s)]
                new = []
                for node, s in zip(names.of(*_flat(sets)).tolist(), sets, strict=True):
                    if node not in seen:
                        seen.add(node)
                        new.append(s)
                if new:
                    flat, n = _flat(new)
                    keys, owner = keys_of(flat, n, segments)
                    yield _batch([("key", pa.array(signed(keys))), ("node", pa.array(names.of(flat, n)[owner]))])
    return run


def _shared(batches):
    """Rows of keys that at least two nodes hold, from rows sorted by key and
    node; ``center`` is the first holder. Streams: only the last row and
    whether it has been given out are kept between batches."""
    last_key = last_node = last_raw = center = None
    given = False
    for b in batches:
        raw = b.column(0).to_numpy(zero_copy_only=False)
        node = b.column(1).to_numpy(zero_copy_only=False)
        if not len(raw):
            continue
        if last_key is not None:
            raw, node = np.r_[last_raw, raw], np.r_[last_node, node]
        key = raw >> 2
        new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
        raw, node, key = raw[new], node[new], key[new]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[starts, len(key)])
        centers = np.repeat(node[starts], size)
        if last_key is not None and size[0]:
            centers[:size[0]] = center  # the group began in an earlier batch
        shared = np.repeat(size > 1, size)
        if last_key is not None and given:
            shared[:size[0]] = True
            shared[0] = False  # given out already
        give = shared.copy()
        last_key, last_raw, last_node, center = key[-1], raw[-1], node[-1], centers[-1]
        # the group goes on with the last row: it has been given out if it
        # was shared, or if it is the row carried over
        given = bool(shared[-1]) or (given and len(starts) == 1 and len(key) == 1)
        if give.any():
            yield _batch([("key", pa.array(raw[give])), ("node", pa.array(node[give])),
                          ("center", pa.array(centers[give]))])


def _texts_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, text)`` of each class in ``nodes``, one text per class.

    A class is found by two hashes of one of its texts. A fixed-size filter
    of the wanted first ones drops most other texts where they are read; the
    join that follows compares both.
    """
    wanted = materialize(nodes.join(classes.select("node", "version", "again"), "node"), "wanted-texts")
    bits = docs.sparkSession.sparkContext.broadcast(build_filter(wanted, "version"))

    def run(batches):
        seen: set[tuple[int, int]] = set()  # copies within a task go once
        for b in batches:
            version, again = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            one = []
            for i in np.flatnonzero(in_filter(bits.value, version.view(U))).tolist():
                if (name := (int(version[i]), int(again[i]))) not in seen:
                    seen.add(name)
                    one.append(i)
            if one:
                yield b.take(pa.array(one))

    texts = docs.select("version", "again", "text").mapInArrow(run, "version bigint, again bigint, text string")
    return texts.join(wanted, ["version", "again"]).select("node", "text").dropDuplicates(["node"])


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""
    pairs = materialize(_may_link(pairs, classes), "candidates")
    ends = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-ends")
    texts = materialize(_texts_of(docs, classes, ends), "candidate-texts")

    def run(batches):
        for b in batches:
            one = {i: s for i, s in shingle_sets(b.column(2), SHINGLE)}
            ok = np.zeros(b.num_rows, bool)
            for i, s in shingle_sets(b.column(3), SHINGLE):
                both = len(np.intersect1d(one[i], s, assume_unique=True))
                ok[i] = 100 * both >= 75 * (len(one[i]) + len(s) - both)
            yield _batch([("a", b.column(0)), ("b", b.column(1))]).filter(pa.array(ok))

    return (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint"))


def _merged(members: DataFrame, centers: DataFrame) -> DataFrame:
    """``(group, node, root, n)``: the members of hot keys in the groups in
    which they are compared.

    ``members(g, node, root, n)`` of hot keys, ``centers(g, center)``. Keys
    with one centre are one group. Two texts often share keys of several
    centres and would meet in each of these groups; so a centre takes over
    the groups of the centres it shares a key with, unless that makes more
    pairs than the groups have by themselves.
    """
    rows = materialize(members.join(centers, "g"), "hot-members")
    # the largest centre among the keys that a centre holds itself
    own = rows.join(centers.select(F.col("center").alias("node")).distinct(), "node", "left_semi")
    heads = own.groupBy("node").agg(F.max("center").alias("head")).withColumnRenamed("node", "center")
    heads = materialize(heads, "group-heads")
    again = heads.select(F.col("center").alias("head"), F.col("head").alias("top"))
    # a head's head; small tables are written, so that Spark sees their size
    # and need not deal the members of a large group by its name
    heads = materialize(heads.join(again, "head").select("center", F.col("top").alias("head")), "group-heads")
    single = materialize(rows.select("center", "node", "root", "n").distinct().join(heads, "center"), "group-members")
    pairs = lambda c: F.sum(F.col(c).cast("double") * F.col(c))
    apart = single.groupBy("center", "head").agg(F.count(F.lit(1)).alias("c")).groupBy("head").agg(pairs("c").alias("apart"))
    joined = single.select("head", "node").distinct().groupBy("head").agg(F.count(F.lit(1)).cast("double").alias("c")) \
        .select("head", (F.col("c") * F.col("c")).alias("joined"))
    merge = materialize(apart.join(joined, "head")
                        .select("head", (F.col("joined") <= F.col("apart")).alias("merge")), "merged-heads")
    return (single.join(merge, "head")
            .select(F.when(F.col("merge"), F.col("head")).otherwise(F.col("center")).alias("group"), "node", "root", "n")
            .distinct())


def _possible(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows(group, node, root, n)`` of large groups without the sets that
    cannot link within their group.

    ``w`` shingles of a set occur in other sets of the group, so two sets
    have at most the smaller ``w`` in common, and link only if 7 times that
    is at least 3 times the sum of their sizes. A set stays if its own ``w``
    allows that with the smallest size, and some set's ``w`` with its size.
    """
    def shingles(batches):
        for b in batches:
            for i, s in shingle_sets(b.column(2), SHINGLE):
                size = len(s)
                for at in range(0, size, 1 << 16):
                    part = s[at:at + (1 << 16)]
                    yield _batch([("group", pa.array(np.full(len(part), b.column(0)[i].as_py()))),
                                  ("node", pa.array(np.full(len(part), b.column(1)[i].as_py()))),
                                  ("shingle", pa.array(signed(part)))])

    found = (rows.select("group", "node").join(texts, "node").select("group", "node", "text")
             .mapInArrow(shingles, "group bigint, node bigint, shingle bigint"))
    alone = (found.groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node"))
             .where("c = 1").groupBy("group", "node").agg(F.count(F.lit(1)).alias("alone")))
    known = materialize(rows.join(alone, ["group", "node"], "left")
                        .withColumn("w", F.col("n") - F.coalesce("alone", F.lit(0))).drop("alone"), "group-shares")
    best = materialize(known.groupBy("group").agg(F.max(7 * F.col("w") - 3 * F.col("n")).alias("most"),
                                                  F.min("n").alias("least")), "group-bounds")
    return (known.join(best, "group")
            .where("7 * w - 3 * n >= 3 * least AND most >= 3 * n").select("group", "node", "root", "n"))


def _forest(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Positions of pairs that connect what all pairs (left, right) do."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            parent[x] = y
            keep.append(i)
    return keep


def _links_between(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of similar enough sets of two lists.

    Only shingles on both sides count; they are taken by the thousand, so
    that matrices stay small.
    """
    sides = (left, right)
    n = [np.array([len(x) for x in side]) for side in sides]
    flat = [np.concatenate(side) for side in sides]
    every = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    row, column = [], []
    for k in (0, 1):
        at = np.searchsorted(every, flat[k])
        ok = at < len(every)
        ok[ok] = every[at[ok]] == flat[k][ok]
        row.append(np.repeat(np.arange(len(sides[k])), n[k])[ok])
        column.append(at[ok])
    common = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(every), 8192):
        m = []
        for k in (0, 1):
            here = (column[k] >= start) & (column[k] < start + 8192)
            x = np.zeros((len(sides[k]), min(8192, len(every) - start)), np.float32)
            x[row[k][here], column[k][here] - start] = 1
            m.append(x)
        common += (m[0] @ m[1].T).astype(np.int64)
    return np.nonzero(100 * common >= 75 * (n[0][:, None] + n[1][None, :] - common))


def _block_links(groups: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links that connect the members of each group as all their links would.

    Members of the group's largest component so far (``root``) are not
    compared with each other, only with the others; these are compared among
    themselves too. Both kinds are dealt to blocks of about ``BLOCK`` sets by
    a hash (fewer, if they are large); every two blocks meet in one task,
    which gives out a forest over the components, never all links.
    """
    groups = materialize(groups, "hot-groups")
    texts = materialize(_texts_of(docs, classes, groups.select("node").distinct()), "hot-texts")
    size = groups.groupBy("group").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > BLOCK).select("group")
    size = materialize(size, "large-groups")
    if not size.isEmpty():
        large = groups.join(size, "group", "left_semi")
        groups = materialize(groups.join(size, "group", "left_anti").unionByName(_possible(large, texts)), "hot-possible")
    roots = groups.groupBy("group", "root").agg(F.count(F.lit(1)).alias("c"))
    largest = roots.groupBy("group").agg(F.max(F.struct("c", "root")).alias("m")).select("group", F.col("m.root").alias("top"))
    rows = groups.join(largest, "group").withColumn("minor", F.col("root") != F.col("top"))
    blocks = lambda minor: F.greatest(F.ceil(F.count_if(minor) / BLOCK),
                                      F.ceil(F.sum(F.when(minor, F.col("n"))) / BLOCK_SHINGLES), F.lit(1).cast("bigint"))
    dealt = rows.groupBy("group").agg(blocks(F.col("minor")).alias("few"), blocks(~F.col("minor")).alias("many"),
                                      F.count_if("minor").alias("minors")).where("minors > 0")
    rows = (rows.join(dealt, "group")
            .withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("minor"), F.col("few")).otherwise(F.col("many")))))
    to = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    task = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.col("own")
    across = F.transform(to("many"), lambda j: task(0, own, j))
    among = F.transform(to("few"), lambda o: task(1, F.least(own, o), F.greatest(own, o)))
    tasks = F.when(F.col("minor"), F.concat(across, among)).otherwise(F.transform(to("few"), lambda i: task(0, i, own)))
    rows = (rows.select("group", "node", "root", "minor", "own", F.explode(tasks).alias("t"))
            .select("group", "t.kind", "t.i", "t.j", "node", "root", "minor", "own").join(texts, "node"))

    def compare(key, block):
        _, kind, i, j = (x.as_py() for x in key)
        own, minor = block.column("own").to_numpy(), block.column("minor").to_numpy()
        node, root = block.column("node").to_numpy(), block.column("root").to_numpy()
        a = np.flatnonzero(minor & (own == i))
        b = np.flatnonzero(minor & (own == j)) if kind else np.flatnonzero(~minor)
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(a) or not len(b):
            return none
        found = dict(shingle_sets(block.column("text"), SHINGLE))
        x, y = _links_between([found[r] for r in a.tolist()], [found[r] for r in b.tolist()])
        apart = root[a[x]] != root[b[y]]
        x, y = a[x[apart]], b[y[apart]]
        if not len(x):
            return none
        # one pair for each two components, then as many as connect them
        _, one = np.unique(np.stack([root[x], root[y]]), axis=1, return_index=True)
        x, y = x[one], y[one]
        keep = _forest(root[x], root[y])
        return pa.table({"a": node[x[keep]], "b": node[y[keep]]})

    return rows.groupBy("group", "kind", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def _uneven_links(docs: DataFrame, classes: DataFrame, names: Names) -> DataFrame | None:
    """Links of the sets whose values don't reach H + 1, by all shingles."""
    uneven = classes.where(F.col("value") < F.floor((F.col("n") + F.floor(4 * F.col("n") / 3)) / 7) + 1)
    uneven = materialize(uneven.select("node"), "uneven")
    if uneven.isEmpty():
        return None

    def shingles(bits):
        def run(batches):
            for b in batches:
                for _, s in shingle_sets(b.column(0), SHINGLE):
                    h = s if bits is None else s[in_filter(bits.value, s)]
                    if len(h):
                        yield _batch([("shingle", pa.array(signed(h))),
                                      ("node", pa.array(np.full(len(h), names.of(*_flat([s]))[0])))])
        return run

    kinds = "shingle bigint, node bigint"
    texts = materialize(_texts_of(docs, classes, uneven), "uneven-texts")
    mine = materialize(texts.select("text").mapInArrow(shingles(None), kinds), "uneven-shingles")
    bits = docs.sparkSession.sparkContext.broadcast(build_filter(mine, "shingle"))
    others = docs.select("text").mapInArrow(shingles(bits), kinds).distinct()
    size = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"))
    return (mine.withColumnRenamed("node", "a").join(others.withColumnRenamed("node", "b"), "shingle")
            .where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
            .join(size("a"), "a").join(size("b"), "b")
            .where("100 * both >= 75 * (na + nb - both)").select("a", "b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       segments=SEGMENTS, name_bits: int = 64) -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id)`` per row of ``docs``:
    ``class_id`` names the row's set (null: empty), ``component_id`` is the
    smallest doc_id reachable by links. With fewer ``name_bits`` more sets
    are named by their second hash."""
    return (_row_components(docs, id_col, text_col, segments, Names(bits=name_bits))
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("node").alias("class_id"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def _row_components(docs: DataFrame, id_col: str, text_col: str, segments=SEGMENTS, names: Names = Names()) -> DataFrame:
    """``(doc_id, version, n, node, root, component_id)`` per row of ``docs``:
    ``version`` is a hash of the text, ``root`` names the component."""
    text = text_of(F.col(f"`{text_col}`"))
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("version"), F.xxhash64(F.lit(1), text).alias("again"))
    rows = materialize(docs.mapInArrow(
        _summaries(segments, names), "doc_id bigint, version bigint, again bigint, n bigint, node bigint, "
        "second bigint, value bigint, parity array<bigint>"), "shingle-sets")

    def classes_of(rows: DataFrame) -> DataFrame:
        one = F.min(F.struct("version", "again"))
        found = (rows.where("node IS NOT NULL").groupBy("node")
                 .agg(F.first("n").alias("n"), F.first("value").alias("value"), F.first("parity").alias("parity"),
                      F.min("doc_id").alias("least"), one.alias("t"), F.min("second").alias("lo"),
                      F.max("second").alias("hi")))
        return materialize(found.select("node", "n", "value", "parity", "least", "t.version", "t.again",
                                        (F.col("lo") != F.col("hi")).alias("shared")), "classes")

    classes = classes_of(rows)
    shared_names = classes.where("shared").select("node").collect()  # next to none, see Names
    if shared_names:
        names = replace(names, shared=tuple(sorted(r.node for r in shared_names)))
        twice = classes.where("shared").select(F.col("node"), F.lit(True).alias("twice"))
        rows = materialize(rows.join(twice, "node", "left").withColumn(
            "node", F.when(F.col("twice"), F.col("second")).otherwise(F.col("node"))).drop("twice"), "shingle-sets")
        classes = classes_of(rows)
    keys = docs.select("text").mapInArrow(_all_keys(segments, names), "key bigint, node bigint")
    group = F.shiftright("key", 2)
    shared = materialize(keys.repartition(group).sortWithinPartitions(group, "node")
                         .mapInArrow(_shared, "key bigint, node bigint, center bigint").drop("center"), "shared-keys")

    def sized(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow a link."""
        size = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"))
        return (pairs.join(size("a"), "a").join(size("b"), "b")
                .where("4 * least(na, nb) >= 3 * greatest(na, nb)").select("a", "b"))

    # the centre of a key is its holder with the largest share of keys that
    # others hold too: of near copies, the one they were made from. A star
    # only has to connect most of a group (the probes below find the rest),
    # so only holders that share a good part of the keys linked sets do are
    # compared
    values = classes.select("node", "value", (F.col("value") - F.floor(
        (F.col("n") + F.floor(4 * F.col("n") / 3)) / 7)).alias("spare"))
    score = materialize(shared.groupBy("node").agg(F.count(F.lit(1)).alias("c")).join(values, "node")
                        .select("node", (F.col("c") / F.col("value")).alias("score"), "spare"), "node-scores")
    ranked = materialize(shared.join(score.select("node", "score"), "node").withColumn("g", group), "ranked-keys")
    centers = ranked.groupBy("g").agg(F.max(F.struct("score", "node")).alias("m")) \
        .select("g", F.col("m.node").alias("a"))
    stars = (ranked.select("g", F.col("node").alias("b")).join(centers, "g").where("a <> b")
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
             .join(score.select(F.col("node").alias("b"), "spare"), "b")
             .where("common >= spare / 4").select("a", "b"))
    links = materialize(_verified(sized(stars), docs, classes), "star-links")
    first = materialize(components(links), "star-components")

    # keys whose holders are not all connected yet
    held = (shared.join(first, "node", "left")
            .withColumn("root", F.coalesce("root", "node")).withColumn("g", group))
    held = materialize(held.join(classes.select("node", "n", "value"), "node"), "held-keys")
    open_keys = (held.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                       F.count(F.lit(1)).alias("cost"))
                 .where("lo <> hi").select("g", "cost"))
    held = materialize(held.join(open_keys, "g").withColumn("kind", F.col("key").bitwiseAND(3)), "open-keys")

    # values a set has to win by probing, beyond its free segments
    own = held.where(F.col("kind") != _PREV)
    lacks = (own.groupBy("node").agg(F.count_if(F.col("kind") == _SINGLE).alias("singles"),
                                     F.count_if(F.col("kind") == _DOUBLE).alias("doubles"),
                                     F.first("n").alias("n"), F.first("value").alias("value"))
             .withColumn("need", F.floor((F.col("n") + F.floor(4 * F.col("n") / 3)) / 7) + 1
                         - (F.col("value") - F.col("singles") - 2 * F.col("doubles")))
             .where("need > 0").select("node", "need", "singles"))
    rank = Window.partitionBy("node", "kind").orderBy("cost", "key")
    probes = (own.join(lacks, "node").withColumn("r", F.row_number().over(rank))
              .where(((F.col("kind") == _SINGLE) & (F.col("r") <= F.col("need")))
                     | ((F.col("kind") == _DOUBLE) & (F.col("need") > F.col("singles"))))
              .select("g", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), "cost"))
    probes = materialize(probes, "probes")
    rare = probes.where(F.col("cost") <= HOT_KEY)
    more = (rare.join(held.select("g", F.col("node").alias("b"), F.col("root").alias("rb"),
                                  F.col("n").alias("nb")), "g")
            .where("ra <> rb AND nb >= na AND 4 * na >= 3 * nb")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # holders of a probed hot key meet under the key's centre, in blocks
    hot = probes.where(F.col("cost") > HOT_KEY).select("g").distinct().join(centers, "g")
    hot = materialize(hot.withColumnRenamed("a", "center"), "hot-keys")
    if not hot.isEmpty():
        groups = _merged(held.select("g", "node", "root", "n"), hot)
        links = links.unionByName(_block_links(groups, docs, classes))
    links = links.unionByName(_verified(more, docs, classes))
    uneven = _uneven_links(docs, classes, names)
    if uneven is not None:
        links = links.unionByName(uneven)

    whole = materialize(components(links), "components")
    linked = classes.select("node", "least").join(whole, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(linked.join(least, "root").select("node", "root", "component_id"), "named-classes")
    return rows.drop("again", "second", "value", "parity").join(named, "node", "left").select(
        "doc_id", "version", "n", "node", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    (doc_id with null last, hash of the text), of equal rows one. Rows with
    an empty set link with nothing and all stay."""
    found = materialize(_row_components(docs, id_col, text_col), "row-components")
    # minima are pre-aggregated: a component may hold very many rows
    best = (found.where("root IS NOT NULL").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                F.col("version").alias("v"))).alias("m"))
            .select(F.col("m.id").alias("keep_id"), F.col("m.v").alias("keep_v")))
    empty = found.where("root IS NULL").select(F.col("doc_id").alias("keep_id"), F.col("version").alias("keep_v"))
    best = materialize(best.withColumn("one", F.lit(True)).unionByName(
        empty.distinct().withColumn("one", F.lit(False))), "component-keepers")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("bigint").alias("i"),
                       F.xxhash64(text_of(F.col(f"`{text_col}`"))).alias("v"))
    kept = rows.join(best, rows.i.eqNullSafe(best.keep_id) & (rows.v == best.keep_v))
    if not found.groupBy("doc_id", "version").count().where("count > 1").isEmpty():
        kept = kept.where("one").dropDuplicates(["i", "v"]).unionByName(kept.where("NOT one"))
    return kept.select("row.*")


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
