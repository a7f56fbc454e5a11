"""Pairs in few bytes and written in shares: same rows, less on disk at a time."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import ratings_df
from corate.operators import item_similarity as sim, pair_similarity as ps, pairs as P, pruned_topk
from corate.session import materialize, scratch_path
from corate.sinks.stores import read_bucketed, write_bucketed


def ratings(spark, seed=1, users=12, items=30):
    rnd = random.Random(seed)
    rows = [(u, 100 + i, rnd.randint(1, 5)) for u in range(users) for i in rnd.sample(range(items), rnd.randint(2, 12))]
    return materialize(ratings_df(spark, rows + [(90, 100 + i, 2) for i in range(items)]), "ratings")


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_co_rated_pairs_stay_where_the_list_is(spark):
    r = ratings(spark)
    got = ps.co_rating_pairs(r, by_item=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "a_item_id" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
    assert rows(got) == rows(ps.co_rating_pairs(r)) and got.count() > 300
    cut = ps.co_rating_pairs(r, by_item=False, block_rows=5)  # a user in several lists
    assert rows(cut) == rows(got)


@pytest.mark.parametrize("most, wanted", [(5, ["c0"]), (2**20, ["c0h", "c0"]), (2**50, ["c0", "c1", "p_text", "p_half"])])
def test_rows_of_lists_are_packed_and_come_back(spark, most, wanted):
    data = [(1, -7, 3.0, 1, None, 0.5), (1, 2**14, None, most, "x", None), (1, 12, 5.0, None, "y", -2.0), (2, 12, -1.0, 3, "z", 1.0)]
    columns = ["rating", "n"] + ["text", "half"] * (len(wanted) > 2)
    r = materialize(spark.createDataFrame(data, "user long, item long, rating double, n long, text string, half double"), "rows")
    assert P._Packed(r, ["item", *columns]).columns == wanted
    at = {"rating": 2, "n": 3, "text": 4, "half": 5}
    want = sorted(((x[0], x[1], *[x[at[c]] for c in columns], y[1], *[y[at[c]] for c in columns])
                   for x in data for y in data if x[0] == y[0] and x[1] != y[1]), key=str)
    got = P.listed_pairs(r, "user", "item", columns, both=True)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert [got.schema[f"b_{c}"].dataType for c in columns] == [r.schema[c].dataType for c in columns]


@pytest.mark.parametrize("measure, most", [("cosine", 10**6), ("adjusted_cosine", 40), ("pearson", 40)])
def test_lists_written_in_shares_are_the_lists(spark, monkeypatch, measure, most):
    r = ratings(spark, 2)
    want = rows(sim.item_neighbours(r, measure, k=6, fill=True))
    monkeypatch.setattr(P, "SHARE_PAIRS", 50)
    monkeypatch.setattr(P, "LISTED_PER_TASK", most)
    made = []
    pairs = P.PairLists.pairs
    monkeypatch.setattr(P.PairLists, "pairs", lambda self, share=0: made.append(share) or pairs(self, share))
    assert rows(sim.item_neighbours(r, measure, k=6, fill=True)) == want
    assert len(made) > 1 and made == list(range(len(made)))


def test_open_light_sums_in_shares(spark, monkeypatch):
    rnd = random.Random(3)
    light = {(u, 100 + i): rnd.randint(1, 5) for u in range(60) for i in rnd.sample(range(30), 8)}
    r = materialize(ratings_df(spark, [(u, i, x) for (u, i), x in light.items()] + [(900, 100 + i, 1) for i in range(30)]), "ratings")
    heavy = pruned_topk.heavy_users(r, "user_id", 20)
    lists = lambda: rows(pruned_topk.pruned_cosine_lists(sim.rated_values(r).rows, heavy, 3, "user_id", "item_id", 50))
    want = lists()
    monkeypatch.setattr(P, "SHARE_PAIRS", 500)
    assert lists() == want


def test_stored_similarities_and_lists_in_shares(spark, monkeypatch):
    r = ratings(spark, 4)
    want = rows(ps.pair_similarity(r))
    monkeypatch.setattr(P, "SHARE_PAIRS", 50)
    path = scratch_path(spark, "store")
    ps.write_pair_similarity(r, path)
    assert rows(spark.read.parquet(path)) == want
    path = scratch_path(spark, "buckets")
    for _ in range(2):  # the second time it replaces the first
        write_bucketed(r, path, "item_id", 4, shares=3)
    got = read_bucketed(spark, path, "item_id", 4)
    assert rows(got) == rows(r)
    plan = got.groupBy("item_id").agg(F.sum("rating"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_written_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert not shuffle_files(spark) - before
