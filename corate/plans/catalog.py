"""Registered queries: each maps the driver tables onto the rating model and
runs one operator (or composite job) over the whole tables.

Every entry has an ANSI-SQL twin in :data:`ORACLE` that computes the same
result directly from the formulas (DuckDB dialect; the driver tables are
views). The twins are deliberately naive: neighbour lists score every item
pair (a cross product of items), kNN scores every user against every query
user. Column names and types match; similarities are evaluated in the same
operation order so both engines produce identical doubles.

The ``ratings`` table is ``lineitem`` joined to ``orders``: user =
``o_custkey``, item = ``l_partkey``, rating = ((quantity - 1) mod 5) + 1,
the largest per (user, item).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.operators import clean, evaluate, indexing, pair_similarity as ps
from corate.operators.item_similarity import item_neighbours, item_stats
from corate.operators.recommend import item_based_recommend, vote_recommend
from corate.operators.split import active_users, holdout, holdout_users
from corate.operators.topk import top_k_list, unfold_lists
from corate.operators.user_knn import QUERY, agreement_knn, l1_knn, user_vectors
from corate.sinks.stores import read_bucketed, write_bucketed
from corate.sinks.text import index_lines, recommendation_lines, triple_lines
from corate.sources.json import parse_reviews
from corate.sources.tables import (
    basket_ratings, event_ratings, load_table, named_order_ratings, order_ratings, raw_order_triples,
)
from corate.session import materialize, scratch_path
from corate.sinks.text import write_lines, write_parquet
from corate.sources.text import (parse_index, parse_recommendation_lines, parse_triples, read_index,
                                 read_recommendation_lines, read_triples, read_user_list, triple_line_counts)
from corate.streaming.topk import read_top_k, stream_top_k

# Fixed values of the reference jobs.
K_ITEM = 100          # neighbours kept per item
K_USER = 100          # nearest users kept per query user
N_VOTE = 5            # recommendations per user, user-kNN job
N_VOTE_EVAL = 10      # recommendations per user, user-kNN evaluation
N_PREDICT = 10        # predicted items per user, item-based evaluation
N_ACTIVE = 25         # most active users held out / queried
N_HOLDOUT = 10        # held-out ratings per test user
N_BEST = 10           # best raters or order lines kept per item
N_HEAVY_K = 20        # neighbours per item where accounts rate everything
N_SMALL = 25          # baskets with the fewest items that are queried
STORE_SHARES = 4      # shares in which the lists of all items are dealt to their store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# shared Spark building blocks

def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    """The ratings table written once, for queries that read it several
    times (user counts, holdout window, both join sides): the
    ``lineitem`` x ``orders`` join and its aggregation run once instead of
    once per reader, and a lost executor re-reads files."""
    return materialize(order_ratings(spark, sf), "ratings")


def _active(r: DataFrame) -> DataFrame:
    return active_users(r, N_ACTIVE).select(USER)


def _split(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    return holdout(r, _active(r), N_HOLDOUT)


def _named_index(spark: SparkSession, sf: str, col: str) -> DataFrame:
    return indexing.build_index(named_order_ratings(spark, sf), col)


# --------------------------------------------------------------------------
# shared SQL building blocks (DuckDB dialect)

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         max(CAST((CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

NAMED = RATINGS + """,
named AS (
  SELECT c_name AS reviewerID, 'P' || CAST(item_id AS VARCHAR) AS asin, rating AS overall
  FROM ratings JOIN customer ON user_id = c_custkey)"""

ACTIVE = f"""active AS (
  SELECT user_id FROM (SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id
                       ORDER BY n DESC, user_id ASC LIMIT {N_ACTIVE}) a)"""

SPLIT = ACTIVE + f""",
test AS (
  SELECT user_id, item_id, rating FROM (
    SELECT r.user_id, r.item_id, r.rating,
           row_number() OVER (PARTITION BY r.user_id ORDER BY r.item_id) AS rn
    FROM ratings r WHERE r.user_id IN (SELECT user_id FROM active)) t
  WHERE rn <= {N_HOLDOUT}),
train AS (
  SELECT r.user_id, r.item_id, r.rating FROM ratings r
  WHERE NOT EXISTS (SELECT 1 FROM test t
                    WHERE t.user_id = r.user_id AND t.item_id = r.item_id))"""


def _cosine_sims(src: str) -> str:
    """All-pairs cosine over ``src(user_id, item_id, rating)``."""
    return f"""st AS (
  SELECT item_id, sum(rating * rating) AS q FROM {src}
  GROUP BY item_id HAVING sum(rating * rating) > 0),
co AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, sum(a.rating * b.rating) AS dot
  FROM {src} a JOIN {src} b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY a.item_id, b.item_id),
sims AS (
  SELECT x.item_id AS item_a, y.item_id AS item_b,
         coalesce(co.dot, 0.0) / (sqrt(x.q) * sqrt(y.q)) + 0.0 AS sim
  FROM st x JOIN st y ON x.item_id < y.item_id
  LEFT JOIN co ON co.item_a = x.item_id AND co.item_b = y.item_id)"""


def _adjusted_sims(src: str) -> str:
    """All-pairs adjusted cosine (user-mean centred, 1e-6 fixed point)."""
    return f"""um AS (
  SELECT user_id, sum(rating) AS s, count(*) AS n FROM {src} GROUP BY user_id),
dev AS (
  SELECT r.user_id, r.item_id,
         CAST(floor((r.rating - um.s / um.n) * 1000000.0 + 0.5) AS BIGINT) AS v
  FROM {src} r JOIN um ON um.user_id = r.user_id),
st AS (
  SELECT item_id, CAST(sum(CAST(v AS HUGEINT) * v) AS DOUBLE) AS q
  FROM dev GROUP BY item_id HAVING sum(CAST(v AS HUGEINT) * v) > 0),
co AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, CAST(sum(CAST(a.v AS HUGEINT) * b.v) AS DOUBLE) AS dot
  FROM dev a JOIN dev b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY a.item_id, b.item_id),
sims AS (
  SELECT x.item_id AS item_a, y.item_id AS item_b,
         coalesce(co.dot, 0.0) / (sqrt(x.q) * sqrt(y.q)) + 0.0 AS sim
  FROM st x JOIN st y ON x.item_id < y.item_id
  LEFT JOIN co ON co.item_a = x.item_id AND co.item_b = y.item_id)"""


def _pearson_sims(src: str) -> str:
    """All-pairs Pearson with full-column means, exact integer algebra."""
    return f"""st AS (
  SELECT item_id, CAST(count(*) AS DOUBLE) AS n, sum(rating) AS s, sum(rating * rating) AS q
  FROM {src} GROUP BY item_id
  HAVING max(rating) > min(rating)),
co AS (
  SELECT a.item_id AS item_a, b.item_id AS item_b, CAST(count(*) AS DOUBLE) AS c,
         sum(a.rating * b.rating) AS dot, sum(a.rating) AS sa, sum(b.rating) AS sb
  FROM {src} a JOIN {src} b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY a.item_id, b.item_id),
sims AS (
  SELECT x.item_id AS item_a, y.item_id AS item_b,
         (x.n * y.n * coalesce(co.dot, 0.0) - x.n * y.s * coalesce(co.sa, 0.0)
          - y.n * x.s * coalesce(co.sb, 0.0) + coalesce(co.c, 0.0) * x.s * y.s)
         / (sqrt(x.n * (x.n * x.q - x.s * x.s)) * sqrt(y.n * (y.n * y.q - y.s * y.s))) + 0.0 AS sim
  FROM st x JOIN st y ON x.item_id < y.item_id
  LEFT JOIN co ON co.item_a = x.item_id AND co.item_b = y.item_id)"""


def _neighbours(k: int = K_ITEM, name: str = "nb") -> str:
    """Top-k directed lists from ``sims``."""
    return f"""directed AS (
  SELECT item_a AS item_id, item_b AS neighbour_id, sim FROM sims
  UNION ALL
  SELECT item_b AS item_id, item_a AS neighbour_id, sim FROM sims),
{name} AS (
  SELECT item_id, neighbour_id, sim, rank FROM (
    SELECT item_id, neighbour_id, sim,
           row_number() OVER (PARTITION BY item_id
                              ORDER BY sim DESC, neighbour_id DESC) AS rank
    FROM directed) t
  WHERE rank <= {k})"""


def _topk_items_sql(sims_cte: str) -> str:
    return f"""WITH {RATINGS},
{sims_cte},
{_neighbours()}
SELECT item_id, neighbour_id, sim, rank FROM nb"""


PAIRS = RATINGS + """,
bc AS (
  SELECT r.user_id, r.item_id, floor(r.rating) AS rating, c.bucket_count
  FROM ratings r JOIN (SELECT item_id, floor(rating) AS rating, count(*) AS bucket_count
                       FROM ratings GROUP BY item_id, floor(rating)) c
    ON c.item_id = r.item_id AND c.rating = floor(r.rating)),
pairs AS (
  SELECT a.user_id, a.item_id AS item_a, b.item_id AS item_b,
         a.rating AS r1, a.bucket_count AS c1, b.rating AS r2, b.bucket_count AS c2
  FROM bc a JOIN bc b ON a.user_id = b.user_id AND a.item_id < b.item_id),
agg AS (
  SELECT item_a, item_b, count(*) AS n, sum(r1) AS s1, sum(r2) AS s2,
         sum(r1 * r1) AS q1, sum(r2 * r2) AS q2, sum(r1 * r2) AS dot,
         max(c1) AS c1_max, max(c2) AS c2_max
  FROM pairs GROUP BY item_a, item_b)"""

PEARSON_SQL = """CASE WHEN sqrt(greatest(n * q1 - s1 * s1, 0.0)) * sqrt(greatest(n * q2 - s2 * s2, 0.0)) > 0
       THEN (n * dot - s1 * s2)
            / (sqrt(greatest(n * q1 - s1 * s1, 0.0)) * sqrt(greatest(n * q2 - s2 * s2, 0.0))) + 0.0
  END"""
COSINE_SQL = "CASE WHEN sqrt(q1) * sqrt(q2) > 0 THEN dot / (sqrt(q1) * sqrt(q2)) + 0.0 END"
COSINE_UNROOTED_SQL = "CASE WHEN q1 * q2 > 0 THEN dot / (q1 * q2) + 0.0 END"
JACCARD_SQL = """CASE WHEN CAST(c1_max + c2_max - n AS DOUBLE) > 0
       THEN CAST(n AS DOUBLE) / CAST(c1_max + c2_max - n AS DOUBLE) END"""


def _overlap(src: str, queries: str) -> str:
    """Per (query user, other user) sums over shared items of ``src``."""
    return f"""ov AS (
  SELECT q.user_id AS query_user, o.user_id, count(*) AS common,
         sum(abs(q.rating) + abs(o.rating) - abs(q.rating - o.rating)) AS gain,
         sum(5.0 - abs(q.rating - o.rating)) AS agree
  FROM {src} q JOIN {src} o ON q.item_id = o.item_id AND q.user_id <> o.user_id
  WHERE q.user_id IN (SELECT user_id FROM {queries})
  GROUP BY q.user_id, o.user_id)"""


def _agreement_knn(src: str, queries: str, k: int = K_USER) -> str:
    """Every query user against every other user, sharing items or not."""
    return _overlap(src, queries) + f""",
tot AS (SELECT user_id, count(*) AS n FROM {src} GROUP BY user_id),
scored AS (
  SELECT qt.user_id AS query_user, ot.user_id,
         coalesce(ov.agree, 0.0) / CAST(qt.n + ot.n - coalesce(ov.common, 0) AS DOUBLE) + 0.0 AS similarity
  FROM tot qt JOIN {queries} a ON a.user_id = qt.user_id
  JOIN tot ot ON ot.user_id <> qt.user_id
  LEFT JOIN ov ON ov.query_user = qt.user_id AND ov.user_id = ot.user_id),
knn AS (
  SELECT query_user, user_id, similarity, rank FROM (
    SELECT query_user, user_id, similarity,
           row_number() OVER (PARTITION BY query_user
                              ORDER BY similarity DESC, user_id ASC) AS rank
    FROM scored) t WHERE rank <= {k})"""


def _votes(src: str, n: int) -> str:
    return f"""votes AS (
  SELECT query_user, item_id, votes, rank FROM (
    SELECT query_user, item_id, votes,
           row_number() OVER (PARTITION BY query_user ORDER BY votes DESC, item_id ASC) AS rank
    FROM (SELECT knn.query_user, r.item_id, count(*) AS votes
          FROM knn JOIN {src} r ON r.user_id = knn.user_id
          GROUP BY knn.query_user, r.item_id) v) t
  WHERE rank <= {n})"""


PREDICT = f"""WITH {RATINGS},
{SPLIT},
{_cosine_sims('train')},
{_neighbours()},
contrib AS (
  SELECT h.user_id, nb.neighbour_id AS item_id, h.rating,
         CAST(CAST(floor(nb.sim * 1000000000.0 + 0.5) AS BIGINT) AS DOUBLE) AS w
  FROM train h JOIN nb ON nb.item_id = h.item_id
  WHERE h.user_id IN (SELECT user_id FROM active)),
pred AS (
  SELECT user_id, item_id,
         CASE WHEN sum(w) = 0 THEN 0.0 ELSE sum(w * rating) / sum(w) + 0.0 END AS prediction
  FROM contrib GROUP BY user_id, item_id),
top AS (
  SELECT user_id, item_id, prediction, rank FROM (
    SELECT user_id, item_id, prediction,
           row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, item_id ASC) AS rank
    FROM pred) t WHERE rank <= {N_PREDICT})"""


# --------------------------------------------------------------------------
# sources, cleaning, ETL

@register("ratings_dedup", f"WITH {RATINGS} SELECT user_id, item_id, rating FROM ratings")
def q_ratings_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_ratings(raw_order_triples(spark, sf), policy="max")


@register("triple_lines", f"""WITH {RATINGS}
SELECT printf('%d %d %f', user_id, item_id, rating) AS value FROM ratings""")
def q_triple_lines(spark: SparkSession, sf: str) -> DataFrame:
    return triple_lines(order_ratings(spark, sf))


@register("triples_text_parse", f"WITH {RATINGS} SELECT user_id, item_id, rating FROM ratings")
def q_triples_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_triples(triple_lines(order_ratings(spark, sf)), mode="strict")


@register("event_ratings", """SELECT user_id, item_id, max(rating) AS rating FROM (
  SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(least(5.0, 1.0 + floor(value / 20)) AS DOUBLE) AS rating
  FROM events) e
WHERE item_id IS NOT NULL AND rating IS NOT NULL
GROUP BY user_id, item_id""")
def q_event_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return event_ratings(spark, sf)


@register("json_reviews", f"WITH {NAMED} SELECT reviewerID, asin, overall FROM named")
def q_json_reviews(spark: SparkSession, sf: str) -> DataFrame:
    named = named_order_ratings(spark, sf)
    lines = named.select(F.to_json(F.struct("reviewerID", "asin", "overall",
                                            F.lit("text").alias("reviewText"))).alias("value"))
    return parse_reviews(lines, "value")


@register("dense_user_index", f"""WITH {NAMED}
SELECT key, row_number() OVER (ORDER BY key) - 1 AS id
FROM (SELECT DISTINCT reviewerID AS key FROM named) k""")
def q_dense_user_index(spark: SparkSession, sf: str) -> DataFrame:
    return _named_index(spark, sf, "reviewerID")


@register("dense_item_index", f"""WITH {NAMED}
SELECT key, row_number() OVER (ORDER BY key) - 1 AS id
FROM (SELECT DISTINCT asin AS key FROM named) k""")
def q_dense_item_index(spark: SparkSession, sf: str) -> DataFrame:
    return _named_index(spark, sf, "asin")


@register("index_lines", f"""WITH {NAMED}
SELECT printf('%s %d', key, row_number() OVER (ORDER BY key) - 1) AS value
FROM (SELECT DISTINCT reviewerID AS key FROM named) k""")
def q_index_lines(spark: SparkSession, sf: str) -> DataFrame:
    return index_lines(_named_index(spark, sf, "reviewerID"))


@register("encode_ratings", f"""WITH {NAMED},
ui AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS id
       FROM (SELECT DISTINCT reviewerID AS key FROM named) k),
ii AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS id
       FROM (SELECT DISTINCT asin AS key FROM named) k)
SELECT ui.id AS user_id, ii.id AS item_id, n.overall AS rating
FROM named n JOIN ui ON ui.key = n.reviewerID JOIN ii ON ii.key = n.asin""")
def q_encode_ratings(spark: SparkSession, sf: str) -> DataFrame:
    # read by both index builds and the encoding: written once
    named = materialize(named_order_ratings(spark, sf), "named-ratings")
    ui = indexing.build_index(named, "reviewerID")
    ii = indexing.build_index(named, "asin")
    enc = indexing.encode(named, ui, "reviewerID", USER)
    enc = indexing.encode(enc, ii, "asin", ITEM)
    return enc.select(USER, ITEM, F.col("overall").alias(RATING))


@register("decode_items", f"""WITH {RATINGS}
SELECT user_id, p_name AS item_name, rating FROM ratings JOIN part ON item_id = p_partkey""")
def q_decode_items(spark: SparkSession, sf: str) -> DataFrame:
    part = load_table(spark, sf, "part").select(F.col("p_name").alias("key"),
                                                F.col("p_partkey").alias("id"))
    r = order_ratings(spark, sf)
    return indexing.decode(r, part, ITEM, "item_name").select(USER, "item_name", RATING)


# --------------------------------------------------------------------------
# per-key statistics

@register("item_rating_histogram", f"""WITH {RATINGS}
SELECT item_id,
       count(*) FILTER (WHERE floor(rating) = 1) AS r1,
       count(*) FILTER (WHERE floor(rating) = 2) AS r2,
       count(*) FILTER (WHERE floor(rating) = 3) AS r3,
       count(*) FILTER (WHERE floor(rating) = 4) AS r4,
       count(*) FILTER (WHERE floor(rating) = 5) AS r5
FROM ratings GROUP BY item_id""")
def q_item_rating_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return clean.rating_histogram(clean.truncate_ratings(order_ratings(spark, sf)))


@register("rating_bucket_count", f"""WITH {RATINGS}
SELECT r.user_id, r.item_id, r.rating, c.bucket_count
FROM ratings r JOIN (SELECT item_id, rating, count(*) AS bucket_count
                     FROM ratings GROUP BY item_id, rating) c
  ON c.item_id = r.item_id AND c.rating = r.rating""")
def q_rating_bucket_count(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_bucket_count(_ratings(spark, sf)).select(
        USER, ITEM, RATING, "bucket_count")


@register("item_stats", f"""WITH {RATINGS}
SELECT item_id, CAST(count(*) AS DOUBLE) AS n, sum(rating) AS s, sum(rating * rating) AS q,
       sqrt(sum(rating * rating)) AS norm
FROM ratings GROUP BY item_id HAVING sum(rating * rating) > 0""")
def q_item_stats(spark: SparkSession, sf: str) -> DataFrame:
    return item_stats(order_ratings(spark, sf), "cosine")


@register("user_mean_centred", f"""WITH {RATINGS}
SELECT r.user_id, r.item_id, r.rating, r.rating - m.s / m.n AS centred
FROM ratings r JOIN (SELECT user_id, sum(rating) AS s, count(*) AS n
                     FROM ratings GROUP BY user_id) m ON m.user_id = r.user_id""")
def q_user_mean_centred(spark: SparkSession, sf: str) -> DataFrame:
    return clean.mean_centred(_ratings(spark, sf), by=USER)


@register("item_mean_centred", f"""WITH {RATINGS}
SELECT r.user_id, r.item_id, r.rating, r.rating - m.s / m.n AS centred
FROM ratings r JOIN (SELECT item_id, sum(rating) AS s, count(*) AS n
                     FROM ratings GROUP BY item_id) m ON m.item_id = r.item_id""")
def q_item_mean_centred(spark: SparkSession, sf: str) -> DataFrame:
    return clean.mean_centred(_ratings(spark, sf), by=ITEM)


# --------------------------------------------------------------------------
# Three-way pair similarity

@register("co_rating_pairs", f"""WITH {PAIRS}
SELECT user_id, item_a, item_b, r1, c1, r2, c2 FROM pairs""")
def q_co_rating_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return ps.co_rating_pairs(_ratings(spark, sf), by_item=False)


@register("pair_aggregates", f"""WITH {PAIRS}
SELECT item_a, item_b, n, s1, s2, q1, q2, dot, c1_max, c2_max FROM agg""")
def q_pair_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return ps.pair_aggregates(ps.co_rating_pairs(_ratings(spark, sf)))


@register("pair_pearson", f"WITH {PAIRS} SELECT item_a, item_b, {PEARSON_SQL} AS pearson FROM agg")
def q_pair_pearson(spark: SparkSession, sf: str) -> DataFrame:
    agg = ps.pair_aggregates(ps.co_rating_pairs(_ratings(spark, sf)))
    return agg.select("item_a", "item_b", ps.pearson_col().alias("pearson"))


@register("pair_cosine", f"""WITH {PAIRS}
SELECT item_a, item_b, {COSINE_SQL} AS cosine, {COSINE_UNROOTED_SQL} AS cosine_unrooted FROM agg""")
def q_pair_cosine(spark: SparkSession, sf: str) -> DataFrame:
    agg = ps.pair_aggregates(ps.co_rating_pairs(_ratings(spark, sf)))
    return agg.select("item_a", "item_b", ps.cosine_col().alias("cosine"),
                      ps.cosine_unrooted_col().alias("cosine_unrooted"))


@register("pair_bucket_jaccard", f"WITH {PAIRS} SELECT item_a, item_b, {JACCARD_SQL} AS jaccard FROM agg")
def q_pair_bucket_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    agg = ps.pair_aggregates(ps.co_rating_pairs(_ratings(spark, sf)))
    return agg.select("item_a", "item_b", ps.jaccard_col().alias("jaccard"))


@register("pair_similarity", f"""WITH {PAIRS}
SELECT item_a, item_b, n, {PEARSON_SQL} AS pearson, {COSINE_SQL} AS cosine,
       {COSINE_UNROOTED_SQL} AS cosine_unrooted, {JACCARD_SQL} AS jaccard
FROM agg""")
def q_pair_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return ps.pair_similarity(_ratings(spark, sf))


# --------------------------------------------------------------------------
# Item neighbour lists (G1, G2, G3, T1, W1), all-pairs semantics

@register("item_cosine_topk", _topk_items_sql(_cosine_sims("ratings")))
def q_item_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return item_neighbours(_ratings(spark, sf), "cosine", k=K_ITEM, fill=True)


@register("item_adjusted_cosine_topk", _topk_items_sql(_adjusted_sims("ratings")))
def q_item_adjusted_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return item_neighbours(_ratings(spark, sf), "adjusted_cosine", k=K_ITEM, fill=True)


@register("item_pearson_topk", _topk_items_sql(_pearson_sims("ratings")))
def q_item_pearson_topk(spark: SparkSession, sf: str) -> DataFrame:
    return item_neighbours(_ratings(spark, sf), "pearson", k=K_ITEM, fill=True)


# --------------------------------------------------------------------------
# C4: user kNN and voting

@register("user_vector_lookup", f"""WITH {RATINGS}, {ACTIVE}
SELECT user_id, item_id, rating FROM ratings WHERE user_id IN (SELECT user_id FROM active)""")
def q_user_vector_lookup(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    return user_vectors(r, _active(r))


@register("user_l1_knn", f"""WITH {RATINGS}, {ACTIVE},
{_overlap('ratings', 'active')},
tot AS (SELECT user_id, sum(abs(rating)) AS s FROM ratings GROUP BY user_id),
cand AS (
  SELECT a.user_id AS query_user, t.user_id,
         qt.s + t.s - coalesce(ov.gain, 0.0) + 0.0 AS distance
  FROM active a JOIN tot qt ON qt.user_id = a.user_id
  JOIN tot t ON t.user_id <> a.user_id
  LEFT JOIN ov ON ov.query_user = a.user_id AND ov.user_id = t.user_id)
SELECT query_user, user_id, distance, rank FROM (
  SELECT query_user, user_id, distance,
         row_number() OVER (PARTITION BY query_user ORDER BY distance ASC, user_id ASC) AS rank
  FROM cand) t WHERE rank <= {K_USER}""")
def q_user_l1_knn(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    return l1_knn(r, _active(r), K_USER)


@register("user_agreement_knn", f"""WITH {RATINGS}, {ACTIVE},
{_agreement_knn('ratings', 'active')}
SELECT query_user, user_id, similarity, rank FROM knn""")
def q_user_agreement_knn(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    return agreement_knn(r, _active(r), K_USER)


@register("knn_vote_recommend", f"""WITH {RATINGS}, {ACTIVE},
{_agreement_knn('ratings', 'active')},
{_votes('ratings', N_VOTE)}
SELECT query_user, item_id, votes, rank FROM votes""")
def q_knn_vote_recommend(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    return vote_recommend(agreement_knn(r, _active(r), K_USER), r, N_VOTE)


@register("recommendation_lines", f"""WITH {RATINGS}, {ACTIVE},
{_agreement_knn('ratings', 'active')},
{_votes('ratings', N_VOTE)}
SELECT c_name AS key,
       c_name || ': ' || coalesce(string_agg('P' || CAST(item_id AS VARCHAR) || ' ', '' ORDER BY rank), '') AS value
FROM active JOIN customer ON c_custkey = user_id LEFT JOIN votes ON query_user = user_id
GROUP BY c_name""")
def q_recommendation_lines(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    return _recommendation_lines(spark, sf, r, _active(r), r, N_VOTE)


def _recommendation_lines(spark, sf, ratings, users, train, n) -> DataFrame:
    votes = vote_recommend(agreement_knn(train, users, K_USER), train, n)
    cust = load_table(spark, sf, "customer").select(F.col("c_name").alias("key"),
                                                    F.col("c_custkey").alias("id"))
    named = (indexing.decode(votes.withColumnRenamed(QUERY, USER), cust, USER, "key")
             .withColumn("item_key", F.concat(F.lit("P"), F.col(ITEM).cast("string"))))
    return recommendation_lines(named, users=indexing.decode(users, cust, USER, "key"))


# --------------------------------------------------------------------------
# Top-k lists as a mergeable aggregate, in a batch and on a stream

@register("item_top_raters", f"""WITH {RATINGS},
ranked AS (
  SELECT item_id, user_id, rating, count(*) OVER (PARTITION BY item_id) AS n,
         avg(rating) OVER (PARTITION BY item_id) AS mean,
         row_number() OVER (PARTITION BY item_id ORDER BY rating DESC, user_id ASC) AS rank
  FROM ratings)
SELECT item_id, n, mean, rating, user_id, rank FROM ranked WHERE rank <= {N_BEST}""")
def q_item_top_raters(spark: SparkSession, sf: str) -> DataFrame:
    """The best raters of each item beside other aggregates of the group."""
    r = order_ratings(spark, sf)
    best = top_k_list(r, [(RATING, "desc"), (USER, "asc")], N_BEST)
    lists = r.groupBy(ITEM).agg(F.count(F.lit(1)).alias("n"), F.avg(RATING).alias("mean"), best.alias("top"))
    return unfold_lists(lists, [ITEM, "n", "mean"])


@register("stream_item_top_lines", f"""SELECT item_id, quantity, order_id, line, rank FROM (
  SELECT l_partkey AS item_id, l_quantity AS quantity, l_orderkey AS order_id, l_linenumber AS line,
         row_number() OVER (PARTITION BY l_partkey
                            ORDER BY l_quantity DESC, l_orderkey ASC, l_linenumber ASC) AS rank
  FROM lineitem) t WHERE rank <= {N_BEST}""")
def q_stream_item_top_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The largest order lines of each item, kept by a stream over lineitem."""
    # a stream reads folders or patterns: the pattern also fits a table of one file
    lines = spark.readStream.schema(load_table(spark, sf, "lineitem").schema).parquet(f"{sf.rstrip('/')}/lineitem.parque[t]")
    lines = lines.select(F.col("l_partkey").alias(ITEM), F.col("l_quantity").alias("quantity"),
                         F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"))
    path = scratch_path(spark, "top-lines")
    order = [("quantity", "desc"), ("order_id", "asc"), ("line", "asc")]
    stream_top_k(lines, [ITEM], order, N_BEST, path, f"{path}-state", once=True).awaitTermination()
    return read_top_k(spark, path, [ITEM])


# --------------------------------------------------------------------------
# Holdout split

@register("active_users", f"""WITH {RATINGS}
SELECT user_id, n_ratings, rank FROM (
  SELECT user_id, n_ratings,
         row_number() OVER (ORDER BY n_ratings DESC, user_id ASC) AS rank
  FROM (SELECT user_id, count(*) AS n_ratings FROM ratings GROUP BY user_id) c) t
WHERE rank <= {N_ACTIVE}""")
def q_active_users(spark: SparkSession, sf: str) -> DataFrame:
    return active_users(order_ratings(spark, sf), N_ACTIVE)


@register("holdout_test", f"WITH {RATINGS}, {SPLIT} SELECT user_id, item_id, rating FROM test")
def q_holdout_test(spark: SparkSession, sf: str) -> DataFrame:
    return _split(_ratings(spark, sf))[0]


@register("holdout_train", f"WITH {RATINGS}, {SPLIT} SELECT user_id, item_id, rating FROM train")
def q_holdout_train(spark: SparkSession, sf: str) -> DataFrame:
    return _split(_ratings(spark, sf))[1]


@register("holdout_user_names", f"""WITH {RATINGS}, {SPLIT}
SELECT DISTINCT c_name AS key FROM test JOIN customer ON c_custkey = user_id""")
def q_holdout_user_names(spark: SparkSession, sf: str) -> DataFrame:
    test, _ = _split(_ratings(spark, sf))
    cust = load_table(spark, sf, "customer").select(F.col("c_name").alias("key"),
                                                    F.col("c_custkey").alias("id"))
    return indexing.decode(holdout_users(test), cust, USER, "key")


# --------------------------------------------------------------------------
# Item-based prediction and its evaluation

def _predict(spark: SparkSession, sf: str):
    r = _ratings(spark, sf)
    test, train = _split(r)
    history = train.join(_active(r), USER, "left_semi")
    # only the lists of items in the query users' histories are read
    nb = item_neighbours(train, "cosine", k=K_ITEM, fill=True, items=history)
    return item_based_recommend(history, nb, N_PREDICT), test


@register("item_based_predict", f"""{PREDICT}
SELECT user_id, item_id, prediction, rank FROM top""")
def q_item_based_predict(spark: SparkSession, sf: str) -> DataFrame:
    return _predict(spark, sf)[0]


@register("eval_euclidean", f"""{PREDICT},
per_user AS (
  SELECT coalesce(p.user_id, t.user_id) AS user_id,
         sqrt(sum((coalesce(p.prediction, 0.0) - coalesce(t.rating, 0.0))
                  * (coalesce(p.prediction, 0.0) - coalesce(t.rating, 0.0)))) AS error
  FROM top p FULL OUTER JOIN test t ON p.user_id = t.user_id AND p.item_id = t.item_id
  GROUP BY coalesce(p.user_id, t.user_id))
SELECT count(*) AS n_users, round(avg(error), 9) AS mean_error
FROM per_user WHERE user_id IN (SELECT user_id FROM test)""")
def q_eval_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    top, test = _predict(spark, sf)
    per = evaluate.euclidean_per_user(top, test)
    return evaluate.mean_metric(per, "error", test, out="mean_error")


def _jaccard_sql(rec: str) -> str:
    return f"""per_user AS (
  SELECT t.user_id,
         CAST((SELECT count(*) FROM {rec} r JOIN test x ON r.user_id = x.user_id AND r.item_id = x.item_id
               WHERE r.user_id = t.user_id) AS DOUBLE)
         / CAST((SELECT count(*) FROM (SELECT item_id FROM {rec} WHERE user_id = t.user_id
                                       UNION SELECT item_id FROM test WHERE user_id = t.user_id) u)
                AS DOUBLE) AS jaccard
  FROM (SELECT DISTINCT user_id FROM test) t)
SELECT count(*) AS n_users, round(avg(jaccard), 9) AS mean_jaccard FROM per_user"""


@register("eval_jaccard_item", f"""{PREDICT},
{_jaccard_sql('top')}""")
def q_eval_jaccard_item(spark: SparkSession, sf: str) -> DataFrame:
    top, test = _predict(spark, sf)
    per = evaluate.jaccard_per_user(top, test)
    return evaluate.mean_metric(per, "jaccard", test, out="mean_jaccard")


# --------------------------------------------------------------------------
# User-kNN evaluation

@register("eval_jaccard_knn", f"""WITH {RATINGS}, {SPLIT},
{_agreement_knn('train', 'active')},
{_votes('train', N_VOTE_EVAL)},
rec AS (SELECT query_user AS user_id, item_id FROM votes),
{_jaccard_sql('rec')}""")
def q_eval_jaccard_knn(spark: SparkSession, sf: str) -> DataFrame:
    r = _ratings(spark, sf)
    test, train = _split(r)
    votes = vote_recommend(agreement_knn(train, _active(r), K_USER), train, N_VOTE_EVAL)
    rec = votes.select(F.col(QUERY).alias(USER), ITEM)
    per = evaluate.jaccard_per_user(rec, test)
    return evaluate.mean_metric(per, "jaccard", test, out="mean_jaccard")


# --------------------------------------------------------------------------
# sparse ratings: user = order, item = part, so that lists need zero rows

BASKETS = """ratings AS (
  SELECT l_orderkey AS user_id, l_partkey AS item_id,
         max(CAST((CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE)) AS rating
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""
SMALLEST = f"""active AS (
  SELECT user_id FROM ratings GROUP BY user_id ORDER BY count(*), user_id LIMIT {N_SMALL})"""


def _baskets(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(basket_ratings(spark, sf), "baskets")


@register("basket_item_cosine_topk", f"""WITH {BASKETS},
{_cosine_sims('ratings')},
{_neighbours()}
SELECT item_id, neighbour_id, sim, rank FROM nb""")
def q_basket_item_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return item_neighbours(_baskets(spark, sf), "cosine", k=K_ITEM, fill=True)


WITH_BOT = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         max(CAST((CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey
  UNION ALL
  SELECT DISTINCT -1 - l_partkey % 3, l_partkey, 1.0 FROM lineitem)"""


@register("item_cosine_topk_heavy_users", f"""WITH {WITH_BOT},
{_cosine_sims('ratings')},
{_neighbours(N_HEAVY_K)}
SELECT item_id, neighbour_id, sim, rank FROM nb""")
def q_item_cosine_topk_heavy_users(spark: SparkSession, sf: str) -> DataFrame:
    """Three accounts that rate a third of all items each with 1: their
    pairs are formed only where they can enter a list."""
    r = order_ratings(spark, sf)
    items = load_table(spark, sf, "lineitem").select(F.col("l_partkey").alias(ITEM)).distinct()
    bots = items.select((F.lit(-1) - F.col(ITEM) % 3).cast("bigint").alias(USER), ITEM, F.lit(1.0).alias(RATING))
    lists = materialize(r.unionByName(bots), "ratings")
    # three accounts of equal size: heavy is what exceeds half of one
    return item_neighbours(lists, "cosine", k=N_HEAVY_K, fill=True, heavy_items=items.count() // 6)


@register("basket_agreement_knn", f"""WITH {BASKETS}, {SMALLEST},
{_agreement_knn('ratings', 'active')}
SELECT query_user, user_id, similarity, rank FROM knn""")
def q_basket_agreement_knn(spark: SparkSession, sf: str) -> DataFrame:
    r = _baskets(spark, sf)
    small = r.groupBy(USER).agg(F.count(F.lit(1)).alias("n")).orderBy("n", USER).limit(N_SMALL)
    return agreement_knn(r, materialize(small.select(USER), "smallest-baskets"), K_USER)


# --------------------------------------------------------------------------
# readers and stores

@register("distinct_triples", """SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id,
       CAST((CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS DOUBLE) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def q_distinct_triples(spark: SparkSession, sf: str) -> DataFrame:
    return clean.distinct_triples(raw_order_triples(spark, sf))


@register("triples_whitespace_parse", f"""WITH {RATINGS} SELECT user_id, item_id, rating FROM ratings""")
def q_triples_whitespace_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Uneven white space, a fractional part to cut off, a fourth field."""
    r = order_ratings(spark, sf)
    lines = r.select(F.format_string(" %d\t%d   %.2f  more", USER, ITEM, F.col(RATING) + 0.75).alias("value"))
    return parse_triples(lines, mode="whitespace", truncate=True)


@register("triple_line_counts", f"""WITH {RATINGS}
SELECT count(*) AS n_lines, count(*) FILTER (rating IN (1, 2)) AS n_parsed,
       count(*) FILTER (rating = 3) AS n_bad_fields, count(*) FILTER (rating IN (4, 5)) AS n_bad_numbers
FROM ratings""")
def q_triple_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lines spoilt by rating: 3 has a double space, 4 is NaN, 5 no number."""
    r = order_ratings(spark, sf)
    line = lambda fmt: F.format_string(fmt, USER, ITEM)
    lines = r.select(F.when(F.col(RATING) == 3, line("%d  %d 3.0")).when(F.col(RATING) == 4, line("%d %d NaN"))
                     .when(F.col(RATING) == 5, line("%d %d five")).otherwise(line("%d %d 1.5")).alias("value"))
    return triple_line_counts(lines)


@register("triples_observed", f"""WITH {RATINGS}
SELECT count(*) AS n_lines, count(*) FILTER (rating IN (1, 2, 4)) AS n_parsed,
       count(*) FILTER (rating = 3) AS n_bad_fields, count(*) FILTER (rating = 5) AS n_bad_numbers,
       count(DISTINCT item_id) FILTER (rating IN (1, 2, 4)) AS n_items
FROM ratings""")
def q_triples_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The reader's counts of good and bad lines, taken while it reads."""
    line = lambda fmt: F.format_string(fmt, USER, ITEM)
    lines = order_ratings(spark, sf).select(
        F.when(F.col(RATING) == 3, line("%d %d")).when(F.col(RATING) == 5, line("%d %d five"))
        .otherwise(line("%d\t%d 1.5 more")).alias("value"))
    seen = Observation("triple lines")
    triples = materialize(parse_triples(lines, "whitespace", observation=seen), "observed-triples")
    counts = [F.lit(seen.get[c]).cast("bigint").alias(c) for c in ("n_lines", "n_parsed", "n_bad_fields", "n_bad_numbers")]
    return triples.agg(F.count_distinct(ITEM).alias("n_items")).select(*counts, "n_items")


@register("growing_index", f"""WITH {NAMED},
first AS (SELECT DISTINCT reviewerID AS key FROM named WHERE overall = 5),
old AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS id FROM first),
new AS (SELECT DISTINCT reviewerID AS key FROM named WHERE reviewerID NOT IN (SELECT key FROM first))
SELECT key, id FROM old
UNION ALL SELECT key, row_number() OVER (ORDER BY key) - 1 + (SELECT count(*) FROM old) AS id FROM new""")
def q_growing_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index file of the users with a 5, extended by all other users."""
    named = materialize(named_order_ratings(spark, sf), "named-ratings")
    path = scratch_path(spark, "index")
    write_lines(index_lines(indexing.build_index(named.where("overall = 5"), "reviewerID")), path)
    return indexing.extend_index(materialize(read_index(spark, path), "index"), named, "reviewerID")


@register("user_list_vectors", f"""WITH {RATINGS}, {ACTIVE}
SELECT user_id, item_id, rating FROM ratings WHERE user_id IN (SELECT user_id FROM active)""")
def q_user_list_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """A file of user names, read back and looked up."""
    r = _ratings(spark, sf)
    cust = load_table(spark, sf, "customer").select(F.col("c_name").alias("key"), F.col("c_custkey").alias("id"))
    path = scratch_path(spark, "users")
    write_lines(indexing.decode(_active(r), cust, USER, "value"), path)
    users = indexing.encode(read_user_list(spark, path).withColumnRenamed("key", "name"), cust, "name", USER)
    return user_vectors(r, users)


@register("stored_pair_similarity", f"""WITH {PAIRS}
SELECT item_a, item_b, n, {PEARSON_SQL} AS pearson, {COSINE_SQL} AS cosine,
       {COSINE_UNROOTED_SQL} AS cosine_unrooted, {JACCARD_SQL} AS jaccard
FROM agg""")
def q_stored_pair_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """The three-way similarities from their store (K4)."""
    path = scratch_path(spark, "pair-similarity")
    ps.write_pair_similarity(_ratings(spark, sf), path)
    return spark.read.parquet(path)


@register("stored_training_set", f"WITH {RATINGS}, {SPLIT} SELECT user_id, item_id, rating FROM train")
def q_stored_training_set(spark: SparkSession, sf: str) -> DataFrame:
    """The training set from its store (K7)."""
    path = scratch_path(spark, "train")
    write_parquet(_split(_ratings(spark, sf))[1], path)
    return spark.read.parquet(path)


@register("encode_with_index_lines", f"""WITH {RATINGS}
SELECT c_custkey AS user_id, item_id, rating FROM ratings JOIN customer ON user_id = c_custkey
WHERE c_acctbal >= 0""")
def q_encode_with_index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings by name, encoded through index lines that name some keys twice
    (the last line wins) and lack the customers in debt (dropped)."""
    cust = load_table(spark, sf, "customer").where("c_acctbal >= 0")
    wrong = cust.select(F.format_string("%s %d", "c_name", F.lit(-1)).alias("value"))
    right = cust.select(F.format_string("%s %d", "c_name", "c_custkey").alias("value"))
    index = materialize(parse_index(wrong.unionByName(right)), "index")
    return indexing.encode(
        named_order_ratings(spark, sf).withColumn(ITEM, F.substring("asin", 2, 20).cast("bigint")),
        index, "reviewerID", USER).select(USER, ITEM, F.col("overall").alias(RATING))


@register("recommendation_lines_parse", f"""WITH {RATINGS}, {ACTIVE},
{_agreement_knn('ratings', 'active')},
{_votes('ratings', N_VOTE)}
SELECT c_name AS key, 'P' || CAST(item_id AS VARCHAR) AS item_key, rank
FROM votes JOIN customer ON c_custkey = query_user""")
def q_recommendation_lines_parse(spark: SparkSession, sf: str) -> DataFrame:
    return parse_recommendation_lines(q_recommendation_lines(spark, sf))


@register("stored_neighbours_predict", f"""{PREDICT}
SELECT user_id, item_id, prediction, rank FROM top""")
def q_stored_neighbours_predict(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of all items, written and read back, as the reference does."""
    r = _ratings(spark, sf)
    _, train = _split(r)
    path = scratch_path(spark, "neighbours")
    write_bucketed(item_neighbours(train, "cosine", k=K_ITEM, fill=True), path, ITEM, shares=STORE_SHARES)
    history = train.join(_active(r), USER, "left_semi")
    return item_based_recommend(history, read_bucketed(spark, path, ITEM), N_PREDICT, stored=True)


@register("eval_jaccard_knn_files", f"""WITH {RATINGS}, {SPLIT},
{_agreement_knn('train', 'active')},
{_votes('train', N_VOTE_EVAL)},
rec AS (SELECT query_user AS user_id, item_id FROM votes),
{_jaccard_sql('rec')}""")
def q_eval_jaccard_knn_files(spark: SparkSession, sf: str) -> DataFrame:
    """C8 from its files: held-out triples and recommendation lines as text."""
    r = _ratings(spark, sf)
    test, train = _split(r)
    held, lines = scratch_path(spark, "holdout"), scratch_path(spark, "recommendations")
    write_lines(triple_lines(test), held)
    write_lines(_recommendation_lines(spark, sf, r, _active(r), train, N_VOTE_EVAL), lines)
    cust = load_table(spark, sf, "customer").select(F.col("c_name").alias("key"), F.col("c_custkey").alias("id"))
    rec = indexing.encode(read_recommendation_lines(spark, lines), cust, "key", USER)
    rec = rec.select(USER, F.substring("item_key", 2, 20).cast("bigint").alias(ITEM))
    test = read_triples(spark, held, mode="whitespace")
    return evaluate.mean_metric(evaluate.jaccard_per_user(rec, test), "jaccard", test, out="mean_jaccard")
