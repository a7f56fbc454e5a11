"""Pairs formed from lists: same pairs as the join, and none is shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import ratings_df
from corate.operators import item_similarity as sim, pair_similarity as ps, pairs as P, pruned_topk
from corate.session import materialize


def triples(seed, users=5, items=24, most=12):
    rnd = random.Random(seed)
    out = [(u, 100 + i, rnd.randint(1, 5)) for u in range(users) for i in rnd.sample(range(items), rnd.randint(1, most))]
    return out + [(90, 100 + i, 2) for i in range(items)] + out[:9]  # a heavy user, rows that come twice


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block, most", [(1000, 10**6), (4, 10**6), (1000, 30), (5, 25)])
@pytest.mark.parametrize("both", [False, True])
def test_listed_pairs_are_the_pairs_of_the_join(spark, block, most, both):
    data = triples(block + most)
    r = ratings_df(spark, data).withColumn("half", F.col("rating") / 2)
    r = r.unionByName(spark.createDataFrame([(None, 101, 1.0, 2.0), (90, None, 1.0, 2.0)], r.schema))
    r = materialize(r.unionByName(spark.createDataFrame([(90, 999, 3.0, None)], r.schema)).repartition(3), "rows")
    rows = [(u, i, float(x), x / 2) for u, i, x in data] + [(90, 999, 3.0, None)]
    want = sorted(((u, i, x, y, j, s, t) for u, i, x, y in rows for v, j, s, t in rows if u == v and (i != j if both else i < j)), key=str)
    got = P.listed_pairs(r, "user_id", "item_id", ["rating", "half"], both, block_rows=block, most=most)
    assert (P.PART in got.columns) == (most < 10**6)
    names = ["user_id", "a_item_id", "a_rating", "a_half", "b_item_id", "b_rating", "b_half"]
    assert sorted(map(tuple, got.select(names).collect()), key=str) == want
    assert [got.schema[n].dataType for n in names[1:4]] == [r.schema[n].dataType for n in ("item_id", "rating", "half")]
    if P.PART in got.columns:  # a function of the pair
        parts = got.groupBy("a_item_id", "b_item_id").agg(F.count_distinct(P.PART).alias("n"))
        assert parts.agg(F.max("n")).first()[0] == 1 and got.agg(F.max(P.PART)).first()[0] > 0


def test_narrow_types_hold_every_value(spark):
    r = spark.createDataFrame([(127, 1.0, 0.5, 40_000, "x", None), (-128, -300.0, 1.0, 1 << 31, "y", None)],
                              "a long, b double, c double, d long, e string, f double")
    assert P.narrow_types(r, r.columns) == {"a": "tinyint", "b": "smallint", "c": "double", "d": "bigint", "e": "string", "f": "double"}
    odd = spark.createDataFrame([(float("nan"), 1e300, float("inf"))], "a double, b double, c double")
    assert set(P.narrow_types(odd, odd.columns).values()) == {"double"}


@pytest.mark.parametrize("most", [10**6, 40])
def test_pair_sums_shuffle_lists_not_pairs(spark, monkeypatch, most):
    data = list({(u, i): x for u, i, x in triples(5)}.items())
    r = materialize(ratings_df(spark, [(u, i, x) for (u, i), x in data]), "ratings")
    whole = sorted(map(tuple, ps.pair_similarity(r).collect()), key=str)
    monkeypatch.setattr(P.listed_pairs, "__defaults__", (*P.listed_pairs.__defaults__[:-1], most))
    got = ps.pair_aggregates(ps.co_rating_pairs(r))
    assert "hashpartitioning(item_a" not in plan(got) and P.PART not in got.columns
    assert sorted(map(tuple, ps.pair_similarity(r).collect()), key=str) == whole and len(whole) > 200


@pytest.mark.parametrize("most", [10**6, 40])
@pytest.mark.parametrize("measure", ["cosine", "pearson"])
def test_lists_are_ranked_where_pairs_are_summed(spark, monkeypatch, measure, most):
    data = list({(u, i): x for u, i, x in triples(6)}.items())
    r = materialize(ratings_df(spark, [(u, i, x) for (u, i), x in data]), "ratings")
    rated = sim.rated_values(r, measure)
    sums = {(x.item_a, x.item_b): x.num / x.den + 0.0 for x in sim.item_pair_sums(rated, measure).collect()}
    every = {}
    for (a, b), v in sums.items():
        every.setdefault(a, []).append((-v, -b))
        every.setdefault(b, []).append((-v, -a))
    want = sorted((i, -b, -v, n + 1) for i, x in every.items() for n, (v, b) in enumerate(sorted(x)[:5]))
    monkeypatch.setattr(P.listed_pairs, "__defaults__", (*P.listed_pairs.__defaults__[:-1], most))
    got = sim.item_neighbours(r, measure, k=5)
    planned = plan(got)
    assert sorted(map(tuple, got.collect())) == want
    if most == 10**6:  # by user and by item, none by pair or neighbour
        assert planned.count("REPARTITION_BY_NUM") == planned.count("Exchange") == 2


def test_short_lists_are_filled_without_pairing_again(spark, monkeypatch):
    """Lists of positive rows hold all co-rated items: nothing is recomputed."""
    r = materialize(ratings_df(spark, [(u, 100 + (u * 7 + d) % 60, 1 + d) for u in range(40) for d in (0, 1, 5)]), "ratings")
    monkeypatch.setattr(sim, "_ranked_again", None)
    monkeypatch.setattr(sim, "dense_index", None)
    got = {}
    for x in sim.item_neighbours(r, "cosine", k=12, fill=True).collect():
        got.setdefault(x.item_id, []).append((x["rank"], x.neighbour_id, x.sim))
    sims = {}
    for x in sim.item_similarity(r).collect():
        sims[x.item_a, x.item_b] = sims[x.item_b, x.item_a] = x.sim
    items = {x.item_id for x in r.collect()}
    assert len(got) == len(items)
    for i in items:
        want = sorted((-sims.get((i, j), 0.0), -j) for j in items if j != i)[:12]
        assert [(n, -j, -s + 0.0) for n, (s, j) in enumerate(want, 1)] == [(n, j, s) for n, j, s in sorted(got[i])]


def test_pruned_lists_write_open_light_sums_only(spark):
    rnd = random.Random(3)
    light = {(u, 100 + i): rnd.randint(1, 5) for u in range(200) for i in rnd.sample(range(40), 5)}
    r = materialize(ratings_df(spark, [(u, i, x) for (u, i), x in light.items()] + [(900, 100 + i, 1) for i in range(40)]), "ratings")
    rated, counts = sim.rated_values(r), {}
    heavy = pruned_topk.heavy_users(rated.rows, "user_id", 20)
    got = sorted(map(tuple, pruned_topk.pruned_cosine_lists(rated.rows, heavy, 3, "user_id", "item_id", 50, counts).collect()))
    assert got == sorted(map(tuple, sim.item_neighbours(r, "cosine", k=3).collect()))
    rows = rated.rows.where("user_id < 900").select("user_id", "item_id", "x", "w")
    norms = rated.rows.where("user_id = 900").groupBy("item_id").agg(F.sum("x").alias("h"))
    kept = pruned_topk._open_light_sums(rows, norms, 3, "user_id", "item_id", 50)
    assert 120 <= kept.count() < counts["light_sums"] / 2
    assert kept.agg(F.sum("light")).first()[0] == counts["light_sums"]
