"""Operator 4: corpus-wide line dedup that returns keep bitmaps.

A line's key is the stripped, lower-cased line. Two 64-bit hashes of the key
are range-partitioned and sorted by (document, position) inside each key, so
the first occurrence of a key streams past first; every later line of
another document loses its bit. Texts never move: the operator returns, per
document with a dropped line, the keep bits as an array of 64-bit words
(lines beyond the array are kept).

Keys holding more than a thousandth of all lines (at most 1000 keys,
whatever the data) skip the sort: their first document comes from a
pre-aggregated minimum and is broadcast, so no task gets a hot key.

Defined results: a null or empty text is one empty line. Rows sharing a
doc_id are one document when keys are counted, and each row gets its own
bits (by a hash of its text). A null doc_id comes after every other id.
Keys shorter than ``min_chars`` code points are never dropped. An empty
table gives no bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import heavy_keys, let, lower_ascii, strip, table, text_of
from corate.session import materialize

MIN_KEY_CHARS = 10
_KEEP_ALL = -1


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``(doc, version, keep_bits)`` for every document that loses a line.

    ``doc`` is the id, ``version`` a hash of the row's text, ``keep_bits``
    an array of longs whose bit ``i % 64`` of word ``i / 64`` is 1 when line
    ``i`` (from 0) stays. Missing words are all ones.
    """
    text = text_of(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), text.alias("t"))
    key = lower_ascii(strip(F.col("line")))
    lines = (rows.select("doc", F.xxhash64("t").alias("version"),
                         F.posexplode(F.split("t", "\n")).alias("pos", "line"))
             .select("doc", "version", "pos", key.alias("key"))
             .where(F.length("key") >= min_chars)
             .select("doc", "version", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))
    lines = materialize(lines, "line-hashes")
    total = lines.count()

    hot = heavy_keys(lines, ["h1", "h2"], total, F.min("doc").alias("first_doc"))
    marked = lines.join(F.broadcast(hot.withColumn("hot", F.lit(True))), ["h1", "h2"], "left")
    cold = (marked.where(F.col("hot").isNull()).drop("hot", "first_doc")
            .repartitionByRange("h1", "h2"))
    # the window needs its key together and sorted by document: the range
    # partitioning already provides that, so it adds a sort but no shuffle
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc").asc_nulls_last())
    cold = cold.withColumn("first_doc", F.first("doc").over(order))
    late = ~F.col("doc").eqNullSafe(F.col("first_doc"))
    dropped = (cold.where(late).select("doc", "version", "pos")
               .unionByName(marked.where("hot").where(late).select("doc", "version", "pos")))
    word = F.floor(F.col("pos") / 64).cast("int")
    bit = F.expr("shiftleft(1L, pos % 64)")
    return (dropped.groupBy("doc", "version", word.alias("word"))
            .agg(F.bit_or(bit).alias("bits"))
            .groupBy("doc", "version")
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
            .select("doc", "version", let(F.col("m"), lambda m: F.transform(
                F.sequence(F.lit(0), F.array_max(F.map_keys(m))),
                lambda i: F.coalesce(F.bitwise_not(m[i]), F.lit(_KEEP_ALL).cast("bigint"))))
                .alias("keep_bits")))


def kept_lines(lines: Column, keep_bits: Column) -> Column:
    """The elements of ``lines`` whose bit in ``keep_bits`` is 1."""
    def keeps(i: Column) -> Column:
        word = F.coalesce(F.get(keep_bits, F.floor(i / 64).cast("int")),
                          F.lit(_KEEP_ALL).cast("bigint"))
        return F.call_function("bit_get", word, F.pmod(i, F.lit(64))) == 1

    return F.filter(lines, lambda x, i: keeps(i))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(row, keep_bits)``: every row of ``docs`` as a struct, with its bits."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("d"),
                       F.xxhash64(text_of(F.col(f"`{text_col}`"))).alias("v"))
    return (rows.join(bitmaps, rows.d.eqNullSafe(bitmaps.doc) & (rows.v == bitmaps.version), "left")
            .select("row", "keep_bits"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text column.

    A text without dropped lines (also a null one) stays as it is.
    """
    bitmaps = materialize(line_bitmaps(docs, id_col, text_col, min_chars), "line-bitmaps")
    joined = with_bitmaps(docs, bitmaps, id_col, text_col)
    old = F.col(f"row.`{text_col}`")
    new = F.when(F.col("keep_bits").isNull(), old).otherwise(
        F.array_join(kept_lines(F.split(old, "\n"), F.col("keep_bits")), "\n"))
    return joined.select(*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c)
                           for c in docs.columns])


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = materialize(line_bitmaps(docs), "line-bitmaps")
    rows = with_bitmaps(docs, bitmaps)
    lines = F.split(text_of(F.col("row.text")), "\n")
    kept = let(lines, lambda x: F.struct(
        F.size(x).alias("n"), F.when(F.col("keep_bits").isNull(), x)
        .otherwise(kept_lines(x, F.col("keep_bits"))).alias("k")))
    return rows.select(F.col("row.doc_id").alias("doc_id"), kept.alias("r")).select(
        "doc_id", F.col("r.n").cast("bigint").alias("n_lines"),
        (F.col("r.n") - F.size("r.k")).cast("bigint").alias("n_dropped"),
        F.sha2(F.array_join("r.k", "\n"), 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT rid, doc_id, unnest(string_split(t, chr(10))) AS line,
         generate_subscripts(string_split(t, chr(10)), 1) AS i
  FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (
  SELECT k.rid, k.doc_id, k.line, k.i, f.key IS NULL OR k.doc_id = f.first_doc AS keep
  FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keep), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
