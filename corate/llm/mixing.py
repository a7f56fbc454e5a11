"""Operator 7: mix sources to target weights by Sainte-Lague apportionment.

Sources get token targets from weights (a target stops at ``max_repeats``
times its source's tokens; the excess is shared again by weight). The mix is
dealt in blocks of ``block_tokens`` tokens: each block goes to the source
with the highest quotient target / (2k - 1), k being its next block. Inside
a source the same rule deals the source's blocks to shards (hash groups of
its documents) by their tokens, which gives an integer quota per shard. In a
shard the documents lie in a seeded order on a ring of tokens; the quota
takes whole rounds of the ring, then blocks from a seeded start. A document's
``taken`` is its overlap with the blocks dealt, repeats counted.

Scale: every per-document step is an aggregation or a window inside one
shard; a source has up to ``MAX_SHARDS`` shards of about ``SHARD_ROWS``
rows, so a source with a third of all rows is spread evenly. Only tables of
one row per source or shard are ranked. Seats that no rounding can change
are dealt in bulk: only the few candidates per party around its exact share
are ranked by quotient.

Defined results: a null or empty text has size 0 and takes 0; a null source
is a source of its own, ordered last; a null doc_id orders like an empty
one; repeated rows are documents of their own. Without any tokens all
targets are 0. An empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import SPACE_RE, strip, table, text_of
from corate.operators.indexing import dense_index
from corate.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_TOKENS = 32
SHARD_ROWS = 256
MAX_SHARDS = 4096
SEED = "mix-1"


def token_count(text: Column) -> Column:
    t = strip(text_of(text))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RE))).cast("bigint")


def _seeded(*parts: Column) -> Column:
    """md5 of the seed and ``parts``, as hex."""
    return F.md5(F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _below(hexed: Column, n: Column) -> Column:
    """A whole number from 0 to n - 1 taken from a hex digest."""
    return F.pmod(F.conv(F.substring(hexed, 1, 8), 16, 10).cast("bigint"), n)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, ord, source_size, n_docs, target)`` from ``(source, size)``.

    Sources ordered by code point, null last, get ``weights`` in turn.
    """
    per = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                  F.count(F.lit(1)).alias("n_docs")), "sources")
    order = dense_index(per, "source", id_col="ord")
    n = order.count()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     (F.col("ord") % len(weights) + 1).cast("int"))
    per = (per.join(order, "source", "left")
           .withColumn("ord", F.coalesce("ord", F.lit(n)))  # the null source
           .withColumn("w", w))
    per = materialize(per, "source-weights")
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.lit(max_repeats) * F.col("source_size")
    num, den = 0, 1  # share of an uncapped source: w * num / den

    def capped() -> Column:
        exact = "decimal(38,0)"
        return (F.col("w").cast(exact) * F.lit(num).cast(exact)
                > cap.cast(exact) * F.lit(den).cast(exact))

    while True:  # the capped set only grows, once per round at least
        over = F.lit(False) if num == 0 else capped()
        full, free = per.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                             F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0))).first()
        new = (total - full, free or 1)
        if new == (num, den):
            break
        num, den = new
    exact_share = F.col("w").cast("double") * F.lit(float(num)) / F.lit(float(den))
    return per.select("source", "ord", "source_size", "n_docs",
                      F.when(capped(), cap.cast("double")).otherwise(exact_share).alias("target"))


def _deal(parties: DataFrame, group: list[str], key: str, share: Column, limit: Column,
          seats: Column, n_parties: Column, out: str) -> DataFrame:
    """Sainte-Lague: ``parties`` with ``out``, the seats each one gets.

    ``share`` is a party's exact share in seats, ``limit`` the most it may
    hold, ``seats`` what its ``group`` deals. The divisor that deals all
    seats differs from one seat by at most (n_parties + 2) / seats, so a
    party's seats below its share less ``margin`` are sure; those up to its
    share plus ``margin`` compete by quotient (ties: ``key``, then k).
    """
    margin = F.ceil(share / F.greatest(seats, F.lit(1)) * (n_parties + 2)) + 2
    p = (parties.withColumn("__share", share).withColumn("__limit", limit.cast("bigint"))
         .withColumn("__seats", seats)
         .withColumn("__sure", F.least(F.greatest(F.floor(F.col("__share")) - margin, F.lit(0)),
                                       F.col("__limit")).cast("bigint"))
         .withColumn("__top", F.least(F.ceil(F.col("__share")) + margin, F.col("__limit")).cast("bigint")))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    p = p.withColumn("__left", F.col("__seats") - F.sum("__sure").over(whole))
    cand = (p.where("__top > __sure")
            .select(*group, key, "__share", "__left",
                    F.explode(F.sequence(F.col("__sure") + 1, F.col("__top"))).alias("__k"))
            .withColumn("__rank", F.row_number().over(
                whole.orderBy((F.col("__share") / (2 * F.col("__k") - 1)).desc(), key, "__k")))
            .where(F.col("__rank") <= F.col("__left"))
            .groupBy(*[F.col(c).alias(f"__{c}") for c in (*group, key)])
            .agg(F.count(F.lit(1)).alias("__won")))
    same = [p[c].eqNullSafe(cand[f"__{c}"]) for c in (*group, key)]
    return (p.join(cand, reduce(lambda x, y: x & y, same), "left")
            .select(*parties.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias(out)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(doc_id, source, shard, size, source_size, target, taken)`` per row of ``docs``."""
    b = block_tokens
    sizes = materialize(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                    F.col(f"`{source_col}`").alias("source"),
                                    token_count(F.col(f"`{text_col}`")).alias("size")), "sizes")
    sources = source_targets(sizes, weights, max_repeats)
    blocks = F.floor((F.sum("source_size").over(Window.partitionBy(F.lit(0))) + b // 2) / b)
    sources = (sources.withColumn("__blocks", blocks)
               .withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))))
    sources = _deal(sources, [], "ord", F.col("target") / b,
                    F.ceil(F.lit(max_repeats) * F.col("source_size") / b), F.col("__blocks"),
                    F.col("__n"), "source_blocks").drop("__blocks", "__n")
    sources = materialize(sources.withColumn("n_shards", F.least(
        F.lit(MAX_SHARDS), F.ceil(F.col("n_docs") / SHARD_ROWS)).cast("bigint")), "source-blocks")

    small = sources.select(F.col("source").alias("s"), "n_shards", "source_size", "target",
                           "source_blocks", "ord")
    rows = (sizes.join(small, sizes.source.eqNullSafe(small.s)).drop("s")
            .withColumn("shard", _below(_seeded(F.lit("shard"), F.col("doc_id")), F.col("n_shards"))))

    shards = (rows.groupBy("ord", "shard", "n_shards", "source_blocks", "source_size")
              .agg(F.sum("size").alias("shard_size")))
    shards = _deal(shards, ["ord"], "shard",
                   F.when(F.col("source_size") > 0, F.col("source_blocks") * F.col("shard_size")
                          / F.col("source_size")).otherwise(F.lit(0.0)),
                   F.ceil(F.lit(max_repeats) * F.col("shard_size") / b),
                   F.col("source_blocks"), F.col("n_shards"), "quota")
    z = F.col("shard_size")
    tokens = F.least(F.col("quota") * b, F.lit(max_repeats) * z)
    shards = (shards.withColumn("tokens", tokens)
              .withColumn("rounds", F.when(z > 0, F.floor(F.col("tokens") / z)).otherwise(F.lit(0)).cast("bigint"))
              .withColumn("rest", F.col("tokens") - F.col("rounds") * z)
              .withColumn("start", b * _below(_seeded(F.lit("start"), F.col("ord"), F.col("shard")),
                                              F.greatest(F.ceil(z / b), F.lit(1))))
              .select(F.col("ord").alias("o"), F.col("shard").alias("h"), "shard_size", "rounds",
                      "rest", "start"))
    shards = materialize(shards, "shard-quotas")

    ring = Window.partitionBy("ord", "shard").orderBy("__key", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("__key", _seeded(F.lit("order"), F.col("doc_id")))
            .withColumn("at", F.coalesce(F.sum("size").over(ring), F.lit(0))))
    rows = rows.join(shards, (rows.ord == shards.o) & (rows.shard == shards.h))

    def overlap(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), hi)
                          - F.greatest(F.col("at"), lo))

    end = F.col("start") + F.col("rest")
    taken = (F.col("rounds") * F.col("size") + overlap(F.col("start"), F.least(end, z))
             + overlap(F.lit(0), end - z))
    return rows.select("doc_id", "source", "shard", "size", "source_size", "target",
                       taken.cast("bigint").alias("taken"))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def _sql() -> str:
    md5 = lambda *x: "md5('" + SEED + ":' || " + " || ':' || ".join(x) + ")"
    below = lambda h, n: f"(('0x' || substr({h}, 1, 8))::BIGINT % ({n}))"
    b, r = BLOCK_TOKENS, MAX_REPEATS
    return f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ord
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE ord % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w,
         {r} * source_size AS cap, (SELECT sum(size) FROM d) AS total
  FROM s),
-- capped are the sources with the smallest cap / w; for each possible number
-- of them the share of the others follows, and the right one is the first
-- whose next source isn't above its cap
f AS (
  SELECT *, total - coalesce(sum(cap) OVER before, 0) AS num, sum(w) OVER rest AS den
  FROM w WINDOW before AS (ORDER BY cap / w, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY cap / w, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g AS (SELECT num, den FROM f WHERE w * num <= cap * den ORDER BY cap / w, ord LIMIT 1),
t AS (
  SELECT w.*, CASE WHEN w * g.num > cap * g.den THEN cap::DOUBLE
                   ELSE w::DOUBLE * g.num::DOUBLE / g.den::DOUBLE END AS target,
         CAST(ceil(cap / {b}) AS BIGINT) AS seat_limit,
         CAST(ceil(n_docs / {SHARD_ROWS}) AS BIGINT) AS shards_wanted
  FROM w, g),
seat AS (
  SELECT ord, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, ord, k) AS rnk
  FROM (SELECT ord, target, unnest(range(1, seat_limit + 1)) AS k FROM t)),
q AS (
  SELECT t.*, least({MAX_SHARDS}, shards_wanted) AS n_shards,
         (SELECT count(*) FROM seat WHERE seat.ord = t.ord
                                      AND rnk <= CAST(floor((total + {b // 2}) / {b}) AS BIGINT)) AS source_blocks
  FROM t),
e AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.ord, q.n_shards, q.source_blocks,
         {below(md5("'shard'", "coalesce(d.doc_id::VARCHAR, '')"), "q.n_shards")} AS shard
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
h AS (
  SELECT ord, shard, any_value(source_blocks) AS source_blocks, any_value(source_size) AS source_size,
         CAST(sum(size) AS BIGINT) AS z
  FROM e GROUP BY ord, shard),
hseat AS (
  SELECT ord, shard,
         row_number() OVER (PARTITION BY ord ORDER BY (source_blocks * z / source_size) / (2 * k - 1) DESC, shard, k)
         AS rnk, source_blocks
  FROM (SELECT *, unnest(range(1, CAST(ceil({r} * z / {b}) AS BIGINT) + 1)) AS k FROM h WHERE source_size > 0)),
won AS (SELECT ord, shard, count(*) AS quota FROM hseat WHERE rnk <= source_blocks GROUP BY ord, shard),
m AS (
  SELECT h.ord, h.shard, z, least(coalesce(quota, 0) * {b}, {r} * z) AS tokens,
         {b} * {below(md5("'start'", "h.ord", "h.shard"), f"greatest(CAST(ceil(z / {b}) AS BIGINT), 1)")} AS st
  FROM h LEFT JOIN won ON h.ord = won.ord AND h.shard = won.shard),
n AS (
  SELECT *, CASE WHEN z > 0 THEN tokens // z ELSE 0 END AS rounds,
         CASE WHEN z > 0 THEN tokens % z ELSE 0 END AS rest FROM m),
c AS (
  SELECT e.*, z, rounds, rest, st,
         coalesce(sum(size) OVER (PARTITION BY e.ord, e.shard
           ORDER BY {md5("'order'", "coalesce(e.doc_id::VARCHAR, '')")}, e.doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ofs
  FROM e JOIN n ON e.ord = n.ord AND e.shard = n.shard)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size + greatest(0, least(ofs + size, least(st + rest, z)) - greatest(ofs, st))
            + greatest(0, least(ofs + size, st + rest - z) - ofs) AS BIGINT) AS taken
FROM c
"""


SQL = _sql()
