"""Operators against brute force on small random inputs; invariants."""

import math
import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SPARSE, ratings_df
from corate.operators import clean, evaluate, indexing
from corate.operators.exact import Sums, fits_long, sums_of
from corate.operators.item_similarity import (Rated, item_neighbours, item_pair_sums, item_similarity,
                                              item_stats)
from corate.operators.pair_similarity import pair_similarity
from corate.operators.pairs import blocked_join, free_ranks, self_pairs
from corate.operators.recommend import item_based_recommend, predict_ratings, vote_recommend
from corate.operators.split import active_users, holdout
from corate.operators.user_knn import agreement_knn, l1_knn
from corate.session import materialize


def random_triples(seed, users=30, items=25, per_user=(1, 12), hot_user=True):
    rnd = random.Random(seed)
    out = []
    for u in range(users):
        n = items if (hot_user and u == 0) else rnd.randint(*per_user)
        for i in rnd.sample(range(items), n):
            out.append((u, 100 + i, rnd.randint(1, 5)))
    return out


def test_blocked_join_splits_hot_keys_without_changing_result(spark):
    data = random_triples(1)
    r = ratings_df(spark, data)
    a = r.select("user_id", F.col("item_id").alias("ia"), F.col("rating").alias("ra"))
    b = r.select("user_id", F.col("item_id").alias("ib"), F.col("rating").alias("rb"))
    plain = sorted(tuple(x) for x in a.join(b, "user_id").collect())
    split = blocked_join(a, b, "user_id", "ia", "ib", block_rows=3)
    assert sorted(tuple(x) for x in split.select(*a.columns, "ib", "rb").collect()) == plain
    # two different sides, both hot on the same key
    split2 = blocked_join(a, b.where("ib > 105"), "user_id", "ia", "ib", block_rows=2)
    plain2 = a.join(b.where("ib > 105"), "user_id")
    assert sorted(tuple(x) for x in split2.select(*plain2.columns).collect()) == \
        sorted(tuple(x) for x in plain2.collect())


def test_item_similarity_unchanged_by_block_split(spark):
    r = ratings_df(spark, random_triples(2))
    for m in ("cosine", "pearson", "adjusted_cosine"):
        a = sorted(tuple(x) for x in item_similarity(r, m).collect())
        b = sorted(tuple(x) for x in item_similarity(r, m, block_rows=4).collect())
        assert a == b


@pytest.mark.parametrize("measure", ["cosine", "pearson", "adjusted_cosine"])
def test_neighbour_lists_with_fill_equal_all_pairs(spark, measure):
    data = random_triples(3, users=12, items=30, per_user=(1, 6), hot_user=False)
    k = 8
    got = {}
    for x in item_neighbours(ratings_df(spark, data), measure, k=k, fill=True).collect():
        got.setdefault(x["item_id"], []).append((x["rank"], x["neighbour_id"], x["sim"]))
    want = brute.neighbour_lists(data, measure, k)
    sims, _ = brute.item_sims(data, measure)
    assert set(got) == set(want)
    tol = 2e-6 if measure == "adjusted_cosine" else 1e-9
    for i, lst in want.items():
        g = sorted(got[i])
        assert [rk for rk, _, _ in g] == list(range(1, len(lst) + 1))
        # same values in the same order (ties may swap equal-valued neighbours)
        assert [s for _, _, s in g] == pytest.approx([s for s, _ in lst], abs=tol)
        for _, n, s in g:
            assert sims[(min(i, n), max(i, n))] == pytest.approx(s, abs=tol)
        # every neighbour clearly above the k-th value is present
        kth = lst[-1][0]
        assert {n for s, n in lst if s > kth + 1e-6} <= {n for _, n, _ in g}


def test_sparse_lists_without_fill_hold_only_co_rated(spark):
    got = item_neighbours(ratings_df(spark, SPARSE), "cosine", k=3).collect()
    assert {(x["item_id"], x["neighbour_id"]) for x in got if x["item_id"] == 50} == set()
    filled = item_neighbours(ratings_df(spark, SPARSE), "cosine", k=3, fill=True).collect()
    fifty = sorted((x["rank"], x["neighbour_id"], x["sim"]) for x in filled if x["item_id"] == 50)
    assert fifty == [(1, 40, 0.0), (2, 30, 0.0), (3, 20, 0.0)]


def test_l1_knn_equals_brute_force(spark):
    data = random_triples(4, users=40, items=40, per_user=(1, 5), hot_user=False)
    r = ratings_df(spark, data)
    rows = brute.rows(data)
    q = [0, 1, 2, 3]
    k = 6
    got = {}
    for x in l1_knn(r, r.select("user_id").where(F.col("user_id").isin(q)).distinct(), k).collect():
        got.setdefault(x["query_user"], []).append((x["rank"], x["user_id"], x["distance"]))
    for u in q:
        cand = sorted((brute.l1(rows[u], rows[v]), v) for v in rows if v != u)[:k]
        assert [(v, d) for _, v, d in sorted(got[u])] == [(v, d) for d, v in cand]


def test_agreement_knn_and_votes(spark):
    data = random_triples(5, users=25, items=20, per_user=(2, 8), hot_user=False)
    r = ratings_df(spark, data)
    rows = brute.rows(data)
    q = r.select("user_id").where("user_id < 3").distinct()
    knn = agreement_knn(r, q, k=5)
    got = {}
    for x in knn.collect():
        got.setdefault(x["query_user"], []).append((x["rank"], x["user_id"], round(x["similarity"], 9)))
    for u in range(3):
        cand = sorted(((-round(brute.agreement(rows[u], rows[v]), 9), v) for v in rows
                       if v != u))[:5]
        assert [(v, -s) for s, v in cand] == [(v, s) for _, v, s in sorted(got[u])]
    votes = vote_recommend(knn, r, n=3).collect()
    for u in range(3):
        nbrs = [v for _, v, _ in got[u]]
        count = {}
        for v in nbrs:
            for i in rows[v]:
                count[i] = count.get(i, 0) + 1
        want = sorted(count.items(), key=lambda t: (-t[1], t[0]))[:3]
        mine = sorted((x["rank"], x["item_id"], x["votes"]) for x in votes if x["query_user"] == u)
        assert [(i, c) for _, i, c in mine] == want


def test_dense_index_matches_sorted_order(spark):
    keys = [f"k{random.Random(7).randint(0, 10**6):07d}-{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:50]], "name string")
    ix = indexing.dense_index(df, "name", num_partitions=7).collect()
    assert sorted((x["name"], x["id"]) for x in ix) == [(k, n) for n, k in enumerate(sorted(keys))]
    desc = indexing.dense_index(df, "name", order=[F.col("name").desc()], id_col="r").collect()
    assert sorted((x["r"], x["name"]) for x in desc) == list(enumerate(sorted(keys, reverse=True)))


def test_encode_decode_round_trip(spark):
    named = spark.createDataFrame([("A", "0012", 5.0), ("B", "X", 3.0), ("A", "X", 1.0)],
                                  "reviewerID string, asin string, overall double")
    ui = indexing.build_index(named, "reviewerID")
    ii = indexing.build_index(named, "asin")
    enc = indexing.encode(indexing.encode(named, ui, "reviewerID", "user_id"), ii, "asin", "item_id")
    assert sorted((x["user_id"], x["item_id"], x["overall"]) for x in enc.collect()) == \
        [(0, 0, 5.0), (0, 1, 1.0), (1, 1, 3.0)]
    dec = indexing.decode(indexing.decode(enc, ui, "user_id", "reviewerID"), ii, "item_id", "asin")
    assert sorted(tuple(x) for x in dec.select(named.columns).collect()) == \
        sorted(tuple(x) for x in named.collect())
    unknown = spark.createDataFrame([("Z", 1.0)], "reviewerID string, overall double")
    assert indexing.encode(unknown, ui, "reviewerID", "user_id").count() == 0
    assert indexing.encode(unknown, ui, "reviewerID", "user_id", keep_unknown=True).count() == 1


def test_dedup_and_histogram(spark):
    raw = spark.createDataFrame([(1, 2, 3.0), (1, 2, 5.0), (1, 3, 2.0), (1, 2, 5.0)],
                                "user_id long, item_id long, rating double")
    assert sorted(tuple(x) for x in clean.dedup_ratings(raw).collect()) == [(1, 2, 5.0), (1, 3, 2.0)]
    assert sorted(tuple(x) for x in clean.dedup_ratings(raw, "avg").collect()) == \
        [(1, 2, 13.0 / 3), (1, 3, 2.0)]
    assert clean.distinct_triples(raw).count() == 3
    h = {x["item_id"]: tuple(x)[1:] for x in clean.rating_histogram(raw).collect()}
    assert h == {2: (0, 0, 1, 0, 2), 3: (0, 1, 0, 0, 0)}


def test_holdout_partitions_ratings(spark):
    data = random_triples(6, users=20, items=30, per_user=(3, 15), hot_user=False)
    r = ratings_df(spark, data)
    top = active_users(r, 5)
    test, train = holdout(r, top.select("user_id"), k=3)
    t = {(x["user_id"], x["item_id"]) for x in test.collect()}
    tr = {(x["user_id"], x["item_id"]) for x in train.collect()}
    assert not (t & tr) and (t | tr) == {(u, i) for u, i, _ in data}
    rows = brute.rows(data)
    act = sorted(rows, key=lambda u: (-len(rows[u]), u))[:5]
    assert [x["user_id"] for x in top.orderBy("rank").collect()] == act
    assert t == {(u, i) for u in act for i in sorted(rows[u])[:3]}


def test_prediction_and_metrics(spark):
    r = ratings_df(spark, SPARSE)
    nb = item_neighbours(r, "cosine", k=10)
    hist = r.where("user_id = 2")
    pred = {x["item_id"]: x["prediction"] for x in predict_ratings(hist, nb).collect()}
    # user 2 rated 10 (5) and 20 (4); item 30 is reached from both
    s10, s20 = 0.157877, 0.160623
    assert pred[30] == pytest.approx((s10 * 5 + s20 * 4) / (s10 + s20), abs=1e-6)
    top = item_based_recommend(hist, nb, n=2).collect()
    assert [x["rank"] for x in sorted(top, key=lambda x: x["rank"])] == [1, 2]
    rec = spark.createDataFrame([(1, 10, 4.0), (1, 20, 2.0), (2, 30, 1.0)],
                                "user_id long, item_id long, prediction double")
    test = spark.createDataFrame([(1, 10, 5.0), (1, 40, 3.0), (3, 50, 2.0)],
                                 "user_id long, item_id long, rating double")
    eu = {x["user_id"]: x["error"] for x in evaluate.euclidean_per_user(rec, test).collect()}
    assert eu == pytest.approx({1: (1 + 4 + 9) ** 0.5, 3: 2.0})
    ja = {x["user_id"]: x["jaccard"] for x in evaluate.jaccard_per_user(rec, test).collect()}
    assert ja == {1: 1 / 3, 3: 0.0}
    m = evaluate.mean_metric(evaluate.jaccard_per_user(rec, test), "jaccard", test).collect()[0]
    assert m["n_users"] == 2 and m["mean_jaccard"] == round(1 / 6, 9)


def test_pair_similarity_block_split_and_symmetry(spark):
    data = random_triples(8)
    r = ratings_df(spark, data)
    a = sorted(tuple(x) for x in pair_similarity(r).collect())
    b = sorted(tuple(x) for x in pair_similarity(r, block_rows=3).collect())
    assert a == b
    assert all(x[0] < x[1] for x in a)
    assert all(v is None or -1 - 1e-12 <= v <= 1 + 1e-12 for x in a for v in (x[3], x[4]))


def test_votes_predictions_and_overlap_unchanged_by_block_split(spark):
    from corate.operators.user_knn import user_overlap
    data = random_triples(9, users=15, items=12, per_user=(2, 10))
    r = ratings_df(spark, data)
    q = r.select("user_id").where("user_id < 4").distinct()
    a = sorted(tuple(x) for x in user_overlap(r, q).collect())
    b = sorted(tuple(x) for x in user_overlap(r, q, block_rows=2, max_broadcast_bytes=0).collect())
    assert a == b and a
    knn = agreement_knn(r, q, k=4)
    assert sorted(tuple(x) for x in vote_recommend(knn, r, 3).collect()) == \
        sorted(tuple(x) for x in vote_recommend(knn, r, 3, block_rows=2,
                                                max_broadcast_bytes=0).collect())
    nb = item_neighbours(r, "cosine", k=5)
    hist = r.where("user_id < 4")
    assert sorted(tuple(x) for x in predict_ratings(hist, nb).collect()) == \
        sorted(tuple(x) for x in predict_ratings(hist, nb, block_rows=2,
                                                 max_broadcast_bytes=0).collect())


@pytest.mark.parametrize("fill", [True, False])
def test_restricted_lists_equal_rows_of_full_lists(spark, fill):
    data = random_triples(11, users=14, items=30, per_user=(1, 7))
    r = ratings_df(spark, data)
    wanted = spark.createDataFrame([(100,), (101,), (107,), (129,), (999,)], "item_id long")
    for m in ("cosine", "pearson", "adjusted_cosine"):
        full = item_neighbours(r, m, k=6, fill=fill)
        part = item_neighbours(r, m, k=6, fill=fill, items=wanted)
        want = sorted(tuple(x) for x in full.join(wanted, "item_id", "left_semi").collect())
        got = sorted(tuple(x) for x in part.collect())
        assert got == want and got


def test_self_pairs_give_each_pair_once_in_order(spark):
    data = random_triples(12, users=6, items=25, per_user=(8, 20))
    r = materialize(ratings_df(spark, data).repartition(3), "pair-rows")
    plain = sorted((u, i, x, j, y) for u, i, x in data for v, j, y in data if u == v and i < j)
    for block in (3, 7, 10_000):
        got = self_pairs(r, "user_id", "item_id", ["rating"], block_rows=block)
        assert sorted(tuple(x) for x in got.select("user_id", "a_item_id", "a_rating", "b_item_id",
                                                   "b_rating").collect()) == plain


def test_a_key_with_a_third_of_the_rows_is_cut(spark):
    """One user with 600 of 1800 ratings: no join key yields more than about
    block_rows^2 pairs."""
    data = [(0, i, 1 + i % 5) for i in range(600)] + [(u, i, 3) for u in range(1, 121) for i in range(10)]
    r = materialize(ratings_df(spark, data), "hot-rows")
    from corate.operators import pairs as P
    got = self_pairs(r, "user_id", "item_id", [], block_rows=100)
    assert got.count() == 600 * 599 // 2 + 120 * 45
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__i" in plan and "__j" in plan and "CartesianProduct" not in plan
    assert P._partitions(r, 3 * P.PAIRS_PER_TASK * 8) >= 24
    j = P.blocked_join(r.select("user_id", "item_id"), r.select("user_id", F.col("item_id").alias("o")),
                       "user_id", "item_id", "o", block_rows=100)
    assert j.count() == 600 * 600 + 120 * 100


def test_key_means_are_joined_as_plain_scans_that_split(spark):
    """With broadcasts off, adaptive execution splits the hot key."""
    keep = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("-1", "1k", "1.5", "4k", "false", "-1"), strict=True):
            spark.conf.set(k, v)
        rows = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("user_id"),
            F.col("id").alias("item_id"), (F.col("id") % 5 + 1.0).alias("rating")).repartition(16)
        r = materialize(rows, "hot-user")
        for df in (clean.mean_centred(r, by="user_id"), clean.with_bucket_count(r, item="user_id")):
            out = df.groupBy().count()
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_free_ranks(spark):
    rnd = random.Random(4)
    total, k = 30, 6
    taken = {o: set(rnd.sample(range(total), n)) for o, n in enumerate([0, 1, 5, 20, 29, 30])}
    rows = spark.createDataFrame([(o, r) for o, s in taken.items() for r in s], "o long, _r long")
    owners = spark.createDataFrame([(o,) for o in taken], "o long")
    got = {}
    for o, r in free_ranks(rows, owners, "o", k, total).collect():
        got.setdefault(o, []).append(r)
    assert {o: sorted(x) for o, x in got.items()} == \
        {o: [r for r in range(total) if r not in s][:k] for o, s in taken.items() if len(s) < total}


@pytest.mark.parametrize("block", [None, 6, 7, 30, 100])
def test_free_ranks_by_blocks(spark, block):
    """Full, empty, half-full and last blocks, for any block of at least k."""
    rnd = random.Random(8)
    total, k = 95, 6
    taken = {o: set(rnd.sample(range(total), n)) for o, n in enumerate([0, 1, 30, 60, 90, 94, 95])}
    taken[7] = set(range(60))
    taken[8] = set(range(0, 95, 2))
    taken[9] = set(range(total)) - {0, 94}
    taken[10] = set(range(6, 12)) | set(range(20, 95))
    rows = spark.createDataFrame([(o, r) for o, s in taken.items() for r in s], "o long, _r long")
    owners = spark.createDataFrame([(o,) for o in taken], "o long")
    got = {}
    for o, r in free_ranks(rows, owners, "o", k, total, block=block).collect():
        got.setdefault(o, []).append(r)
    assert {o: sorted(x) for o, x in got.items()} == \
        {o: [r for r in range(total) if r not in s][:k] for o, s in taken.items() if len(s) < total}


def test_fractional_ratings_give_one_bit_pattern(spark):
    """Averages and ratings such as 1.1, whatever the order of the rows."""
    rnd = random.Random(3)
    raw = [(u, 100 + i, rnd.choice([1.1, 2.3, 4.7, 5.0, 1e-9, 3.3])) for u in range(400) for i in range(6) for _ in range(3)]
    seen = {}
    for n in (1, 2, 3, 5, 8, 13):
        r = ratings_df(spark, raw).repartition(n, F.rand(n))
        avg = materialize(clean.dedup_ratings(r, "avg").repartition(n, F.rand(n)), "avg")
        q = avg.select("user_id").where("user_id < 3").distinct()
        for name, df in {
                "avg": avg, "means": clean.mean_centred(avg, "user_id"), "stats": item_stats(avg),
                "cosine": item_similarity(avg), "adjusted": item_similarity(avg, "adjusted_cosine"),
                "pearson": item_similarity(avg, "pearson"), "l1": l1_knn(avg, q, 5),
                "agreement": agreement_knn(avg, q, 5)}.items():
            seen.setdefault(name, set()).add(str(sorted(map(repr, df.collect()))))
    assert {k: len(v) for k, v in seen.items()} == dict.fromkeys(seen, 1)


def test_limb_sums_are_correctly_rounded(spark):
    rnd = random.Random(5)
    values = [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randrange(-6, 6) for _ in range(5000)] + [1.1] * 5000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    sums = sums_of(df, "v")
    assert not sums.plain
    got = df.agg(*sums.aggregates(F.col("v"), "s"), *sums.aggregates(F.col("v") * F.col("v"), "q", 2)) \
        .select(sums.total("s"), sums.total("q", 2)).first()
    assert got[0] == pytest.approx(math.fsum(values), rel=2e-16, abs=0)
    assert got[1] == pytest.approx(math.fsum(v * v for v in values), rel=2e-16, abs=0)
    assert sums_of(df.where("v < -1e9"), "v").plain
    assert sums_of(spark.createDataFrame([(0.25,), (-5.0,)], "v double"), "v").plain


def test_products_beyond_a_long_are_summed_exactly(spark):
    """x = 4e9 per rating, the value of an item with tens of millions of
    raters: the sum of products exceeds a long."""
    big, n = 4_000_000_000, 3000
    rows = spark.range(n).select(F.col("id").alias("user_id"), F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("item_id"), (F.lit(big) + F.col("id") * i).cast("long").alias("x"),
                 F.lit(1.0).alias("d")) for i in (1, 2)])).alias("r")).select("user_id", "r.*")
    want = sum((big + u) * (big + 2 * u) for u in range(n))
    assert want > 1 << 63
    for measure, scale in (("pearson", 4096.0), ("adjusted_cosine", 1.0)):
        for parts in (1, 5):
            rated = Rated(materialize(rows.repartition(parts, F.rand(parts)), "rated"), Sums(), fits_long(big + 2 * n, n))
            got = item_pair_sums(rated, measure).collect()
            assert [(r.item_a, r.item_b, r.num) for r in got] == [(1, 2, float(want) / scale)]


def test_narrow_and_wide_products_agree(spark, monkeypatch):
    r = ratings_df(spark, random_triples(11))
    for measure in ("pearson", "adjusted_cosine"):
        narrow = sorted(map(tuple, item_similarity(r, measure).collect()))
        with monkeypatch.context() as m:
            m.setattr("corate.operators.item_similarity.fits_long", lambda *a: False)
            assert sorted(map(tuple, item_similarity(r, measure).collect())) == narrow


def test_agreement_fill_only_where_lists_are_short(spark):
    """Lists of users with many, few and no similar users, brute force."""
    data = random_triples(12, users=25, items=40, per_user=(1, 4), hot_user=True)
    data += [(90, 999, 3)]  # shares no item with anyone
    k = 6
    r = ratings_df(spark, data)
    q = spark.createDataFrame([(0,), (1,), (2,), (90,), (777,)], "user_id long")
    got = {}
    for x in agreement_knn(r, q, k).collect():
        got.setdefault(x["query_user"], []).append((x["rank"], x["user_id"], x["similarity"]))
    vec = {}
    for u, i, v in data:
        vec.setdefault(u, {})[i] = v
    for u in (0, 1, 2, 90):
        scored = []
        for o in vec:
            if o != u:
                common = vec[u].keys() & vec[o].keys()
                scored.append((-sum(5 - abs(vec[u][i] - vec[o][i]) for i in common) / len(vec[u].keys() | vec[o].keys()), o))
        assert [x[1] for x in sorted(got[u])] == [o for _, o in sorted(scored)[:k]]
    assert set(got) == {0, 1, 2, 90}


def test_adjusted_cosine_does_not_depend_on_partitioning(spark):
    """Two items with 20,000 common raters: one bit pattern for any order."""
    rows = spark.range(20_000).select(F.col("id").alias("user_id"), F.explode(F.array(*[F.struct(
        F.lit(i).cast("long").alias("item_id"),
        ((F.xxhash64("id", F.lit(i)) % 5 + 5) % 5 + 1).cast("double").alias("rating")) for i in range(3)])).alias("x"))
    rows = rows.select("user_id", "x.item_id", "x.rating")
    seen = {m: set() for m in ("adjusted_cosine", "pearson")}
    for n in (1, 3, 8):
        r = rows.repartition(n, F.rand(n))
        for m in seen:
            seen[m].add(str(sorted(tuple(x) for x in item_similarity(r, m).collect())))
    assert all(len(v) == 1 for v in seen.values())


def test_items_with_one_value_have_no_pearson(spark):
    data = [(u, 1, 1.1) for u in range(7)] + [(u, 2, 1.0 + u % 3) for u in range(7)] + [(u, 3, 5 - u % 2) for u in range(7)]
    got = item_neighbours(ratings_df(spark, data), "pearson", k=5)
    assert {(x["item_id"], x["neighbour_id"]) for x in got.collect()} == {(2, 3), (3, 2)}


def test_seen_items_can_be_left_out_and_weights_made_absolute(spark):
    r = ratings_df(spark, random_triples(9, users=15, items=12, per_user=(2, 10)))
    q = r.select("user_id").where("user_id < 4").distinct()
    own = {(x["user_id"], x["item_id"]) for x in r.collect()}
    votes = vote_recommend(agreement_knn(r, q, k=4), r, 20, exclude_seen=True).collect()
    assert votes and not {(x["query_user"], x["item_id"]) for x in votes} & own
    nb = item_neighbours(r, "pearson", k=5)
    top = item_based_recommend(r.where("user_id < 4"), nb, 20, exclude_seen=True).collect()
    assert not {(x["user_id"], x["item_id"]) for x in top} & own
    # the mean of ratings under absolute weights stays within their range
    preds = predict_ratings(r.where("user_id < 4"), nb, abs_weights=True).collect()
    assert preds and all(abs(x["prediction"]) <= 5 + 1e-9 for x in preds)
    signed = {tuple(x)[:2]: x["prediction"] for x in predict_ratings(r.where("user_id < 4"), nb).collect()}
    assert any(abs(signed[tuple(x)[:2]] - x["prediction"]) > 1e-6 for x in preds)


def test_a_rating_outside_the_levels_fails_the_histogram(spark):
    with pytest.raises(Exception, match="rating outside the levels: 7"):
        clean.rating_histogram(ratings_df(spark, [(1, 2, 7.0)])).collect()


@pytest.mark.parametrize("k, hot_rating", [(3, 1), (3, 5), (12, 2)])
def test_pruned_lists_equal_full_lists_with_fewer_pairs(spark, k, hot_rating):
    """Accounts that rate (nearly) everything, popular and rare items."""
    rnd = random.Random(k + hot_rating)
    data = {}
    for u in range(250):
        for i in rnd.sample(range(40), rnd.randint(1, 6)):
            data[u, 100 + i] = rnd.randint(1, 5)
    for i in range(70):  # items 40 to 69 have heavy raters only
        data[900, 100 + i] = hot_rating
        if i % 2:
            data[901, 100 + i] = rnd.randint(1, hot_rating)
    r = ratings_df(spark, [(u, i, v) for (u, i), v in data.items()]).repartition(5)
    for fill in (False, True):
        counts = {}
        full = sorted(map(tuple, item_neighbours(r, "cosine", k=k, fill=fill).collect()))
        got = sorted(map(tuple, item_neighbours(r, "cosine", k=k, fill=fill, heavy_items=20, block_rows=50, counts=counts).collect()))
        assert got == full
        assert counts["heavy_pairs"] == 70 * 69 + 35 * 34
        assert counts["heavy_pairs_formed"] < counts["heavy_pairs"]
    if hot_rating == 1:
        assert counts["heavy_pairs_formed"] < counts["heavy_pairs"] / 2


def test_negative_ratings_are_not_pruned(spark):
    data = [(u, i, (u * i) % 7 - 3) for u in range(30) for i in range(12)]
    r = ratings_df(spark, data)
    assert sorted(map(tuple, item_neighbours(r, "cosine", k=4, heavy_items=5).collect())) == \
        sorted(map(tuple, item_neighbours(r, "cosine", k=4).collect()))
