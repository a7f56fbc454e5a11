"""Operator 6: benchmark decontamination with spaced seeds.

Benchmark items and documents become lower-cased words. Four fixed masks of
weight 7 pick word positions and ignore the others; a seed is the hash of
the picked words. Documents' seeds are joined with the items' seeds, and
each hit is verified around its diagonal: an item leaks into a document if
``WINDOW`` consecutive words of it stand there with at most
``MAX_SUBSTITUTIONS`` of them replaced. The masks are lossless for this: for
every choice of two replaced words among 13, one mask at one place picks
none of them (checked by a test over all 78 choices). An item shorter than
the window leaks if it occurs as a whole: one of at least ``MIN_MASKED``
words with at most one of them replaced (the same masks are lossless for
that, also tested), a shorter one unchanged.

A filter of fixed size (4 MB) made from the items' seeds drops nearly all
other seeds where the texts are read, so neither the benchmark nor the
corpus has to be small; the join decides. A passage that very many
documents share gives one row per document and seed, in a join Spark can
split.

Defined results: null or empty texts and items match nothing. Rows sharing
a doc_id (also a null one) are checked each and reported each. Items that
share an id are one item; those without an id are searched too and reported
as one item whose id is null. An empty benchmark leaks nowhere; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import table, text_of
from corate.llm.textscan import U, build_filter, chunks, in_filter, mix, signed, word_hashes
from corate.session import materialize

WINDOW = 13
MAX_SUBSTITUTIONS = 2
MIN_MASKED = 10  # shorter items are matched unchanged
MASKS = ("11110111", "1110100111", "1100111011", "11111101")


def substitutions(n: int) -> int:
    """How many words may be replaced in the window of an item of n words."""
    return MAX_SUBSTITUTIONS if n >= WINDOW else int(n >= MIN_MASKED)


def seeds(words: np.ndarray, ends: np.ndarray, picked: tuple[int, ...], salt: int):
    """Seeds of one mask at every place of ``words`` where it fits before
    the end of its text: (places, hashes). ``ends``: end of each word's text."""
    span = picked[-1] + 1
    n = len(words) - span + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, U)
    h = np.full(n, U(salt))
    for p in picked:
        h = h * U(0xD1342543DE82EF95) + words[p:p + n]
    at = np.flatnonzero(np.arange(n) + span <= ends[:n])
    return at, mix(h[at], 21)


def _shapes(short_lengths) -> list[tuple[tuple[int, ...], int]]:
    """(picked positions, salt) of the masks and of whole short items."""
    out = [(tuple(i for i, c in enumerate(m) if c == "1"), k) for k, m in enumerate(MASKS)]
    return out + [(tuple(range(n)), 1000 + n) for n in short_lengths]


def _item_seeds(batches):
    """(seed, item, place) of each benchmark item."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        seed, item, place = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, data, offsets in chunks(b.column(1)):
            words, at = word_hashes(data, offsets)
            for i in range(len(offsets) - 1):
                w = words[at[i]:at[i + 1]]
                n = len(w)
                shapes = _shapes([n])[-1:] if n < MIN_MASKED else _shapes([])
                for picked, salt in shapes if n else []:
                    p, h = seeds(w, np.full(n, n), picked, salt)
                    seed.append(h)
                    item.append(np.full(len(h), ids[first + i], np.int64))
                    place.append(p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(np.concatenate(seed))), pa.array(np.concatenate(item)),
             pa.array(np.concatenate(place))], ["seed", "item", "item_at"])


def _hits(bits, short_lengths):
    """Rows whose text has a seed that the filter lets pass, with the seeds."""
    shapes = _shapes(short_lengths)

    def run(batches):
        for b in batches:
            rows, found, places = [], [], []
            for first, data, offsets in chunks(b.column(1)):
                words, at = word_hashes(data, offsets)
                text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
                ends = at[1:][text]
                got = []
                for picked, salt in shapes:
                    p, h = seeds(words, ends, picked, salt)
                    ok = in_filter(bits.value, h)
                    got.append((p[ok], h[ok]))
                p, h = (np.concatenate(x) for x in zip(*got, strict=True))
                if not len(p):
                    continue
                order = np.argsort(text[p], kind="stable")
                p, h = p[order], h[order]
                which, start = np.unique(text[p], return_index=True)
                for i, lo, hi in zip(which, start, np.r_[start[1:], len(p)], strict=True):
                    rows.append(first + int(i))
                    found.append(signed(h[lo:hi]))
                    places.append(p[lo:hi] - at[i])
            if rows:
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(found, pa.list_(pa.int64())),
                     pa.array(places, pa.list_(pa.int64()))], ["doc_id", "text", "seeds", "places"])
    return run


def best_overlap(words: np.ndarray, item: np.ndarray, diagonals) -> tuple[int, int, int] | None:
    """``(matching words, start, end)`` of the item's best window in the
    text's words on one of the diagonals, if it has few enough substitutions."""
    n, best = len(item), None
    size = min(WINDOW, n)
    allowed = substitutions(n)
    for d in sorted(diagonals):
        same = np.zeros(n, np.int64)
        lo, hi = max(0, -d), min(n, len(words) - d)
        if hi <= lo:
            continue
        same[lo:hi] = words[d + lo:d + hi] == item[lo:hi]
        runs = np.convolve(same, np.ones(size, np.int64), "valid")
        ok = np.flatnonzero(runs >= size - allowed)
        if len(ok):
            covered = np.zeros(n, bool)
            for k in ok:
                covered[k:k + size] = True
            hit = int(same[covered].sum())
            if best is None or hit > best[0]:
                best = (hit, d + int(ok[0]), d + int(ok[-1]) + size)
    return best


def _verify(batches):
    for b in batches:
        texts, items = {}, {}
        for out, col in ((texts, b.column(2)), (items, b.column(3))):
            for first, data, offsets in chunks(col):
                words, at = word_hashes(data, offsets)
                for i in range(len(offsets) - 1):
                    out[first + i] = words[at[i]:at[i + 1]]
        got = [best_overlap(texts[i], items[i], d) for i, d in enumerate(b.column(4).to_pylist())]
        ok = [i for i, x in enumerate(got) if x]
        take = pa.array(ok, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(take), b.column(1).take(take),
             *[pa.array([got[i][k] for i in ok], pa.int64()) for k in range(3)]],
            ["uid", "item", "matched", "start", "end"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, version, item_id, matched, start, end)``: benchmark items
    found in documents, with the matching words and the words' span.
    ``version`` is a hash of the row's text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"),
                             text_of(F.col(f"`{item_text_col}`")).alias("item_text")).distinct()
    items = materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_text", "item_id"), "items")
    n = F.size(F.filter(F.split("item_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    short = [r[0] for r in items.select(n.alias("n")).where(f"n > 0 AND n < {MIN_MASKED}").distinct().collect()]
    wanted = materialize(items.mapInArrow(_item_seeds, "seed bigint, item bigint, item_at bigint"), "item-seeds")
    bits = spark.sparkContext.broadcast(build_filter(wanted, "seed"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    found = rows.mapInArrow(_hits(bits, sorted(short)),
                            f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, "
                            "seeds array<bigint>, places array<bigint>")
    found = materialize(found.withColumn("uid", F.monotonically_increasing_id()), "seeded-documents")
    pairs = (found.select("uid", F.explode(F.arrays_zip("seeds", "places")).alias("x"))
             .select("uid", F.col("x.seeds").alias("seed"), F.col("x.places").alias("at"))
             .join(wanted, "seed")
             .select("uid", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
             .groupBy("uid", "item").agg(F.collect_list("diagonal").alias("diagonals")))
    pairs = materialize(pairs, "seed-pairs")
    # items sharing an id are checked each, and their best result is kept
    kinds = "uid bigint, item bigint, matched bigint, start bigint, end bigint"
    good = (pairs.join(found.select("uid", "text"), "uid").join(items, "item")
            .select("uid", "item", "text", "item_text", "diagonals").mapInArrow(_verify, kinds)
            .join(items.select("item", "item_id"), "item")
            .groupBy("uid", "item_id").agg(F.max(F.struct("matched", "start", "end")).alias("m")))
    return (good.join(found.select("uid", "doc_id", F.xxhash64("text").alias("version")), "uid")
            .select("doc_id", "version", "item_id", "m.matched", "m.start", "m.end"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item leaks."""
    bad = materialize(leaks(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias("__d"), F.col("version").alias("__v")).distinct(), "leaking-documents")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("d"),
                       F.xxhash64(text_of(F.col(f"`{text_col}`"))).alias("v"))
    return (rows.join(bad, rows.d.eqNullSafe(bad["__d"]) & (rows.v == bad["__v"]), "left_anti")
            .select("row.*"))


def query(spark, sf_dir) -> DataFrame:
    """Per document: whether it leaks, the items (one without an id as
    ``null``), and the words matched."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = table(spark, sf_dir, "benchmark")
    found = (leaks(docs, bench).groupBy("doc_id", "version")
             .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("item_id")).alias("i"),
                  F.max("matched").alias("m"))
             .withColumn("i", F.concat(F.col("i").cast("array<string>"), F.when(
                 F.col("n") > F.size("i"), F.array(F.lit("null"))).otherwise(F.array().cast("array<string>")))))
    found = materialize(found, "document-leaks").withColumnRenamed("doc_id", "d")
    rows = docs.select("doc_id", F.xxhash64(text_of(F.col("text"))).alias("v"))
    return (rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.v == found.version), "left")
            .select("doc_id", F.col("n").isNotNull().alias("contaminated"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n_items"),
                    F.coalesce(F.array_join("i", ","), F.lit("")).alias("item_ids"),
                    F.coalesce("m", F.lit(0)).cast("bigint").alias("matched_words")))
