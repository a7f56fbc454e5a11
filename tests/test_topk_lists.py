"""Top-k lists as an aggregate: equal to the window form, mergeable, bounded."""

import random

import pytest
from pyspark.sql import functions as F

from corate.operators.topk import top_k, top_k_list, unfold_lists
from corate.streaming import read_top_k, stream_top_k

SCHEMA = "g long, x double, n long, id long, note string"
NAN, INF, LOW = float("nan"), float("inf"), -(1 << 63)


def rows_of(seed, n=600):
    """Ties, nulls, NaN, infinities and the extreme longs; one group holds a third."""
    rnd = random.Random(seed)
    xs, ns = [None, NAN, INF, -INF, 0.0, -0.0, 1.5, 2.0], [None, LOW, -LOW - 1, 0, 1, 2]
    return [(0 if rnd.random() < 1 / 3 else rnd.choice([None, *range(1, 9)]), rnd.choice(xs), rnd.choice(ns), i,
             rnd.choice([None, "", "a"])) for i in range(n)]


def as_columns(order):
    return [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in order]


def listed(df, order, k, fields=()):
    lists = df.groupBy("g").agg(top_k_list(df, order, k, fields).alias("top"))
    return unfold_lists(lists, ["g"])


def tuples(df, cols):
    return sorted((tuple(map(repr, r)) for r in df.select(*cols).collect()))


@pytest.mark.parametrize("order", [
    [("x", "desc"), ("id", "asc")], [("x", "asc"), ("id", "desc")], [("n", "desc"), ("x", "asc"), ("id", "asc")],
    [("note", "asc"), ("n", "asc"), ("id", "desc")]])
def test_lists_equal_the_window_form(spark, order):
    cols = ["g", "x", "n", "id", "note", "rank"]
    for parts, k in ((1, 1), (7, 5), (40, 1000)):
        df = spark.createDataFrame(rows_of(parts), SCHEMA).repartition(parts)
        got = listed(df, order, k, ["x", "n", "note"])
        assert tuples(got, cols) == tuples(top_k(df, "g", as_columns(order), k), cols)


def test_map_tasks_ship_bounded_lists(spark):
    """Partial and final aggregation, and no sort of rows in the plan."""
    df = spark.range(100_000).select(F.lit(1).alias("g"), (F.col("id") % 97).alias("x"), "id").repartition(8)
    lists = df.groupBy("g").agg(top_k_list(df, [("x", "desc"), ("id", "asc")], 3).alias("top"), F.count("*").alias("n"))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_top_k" in plan and "Sort" not in plan.replace("SortAggregate", "")
    r = lists.first()
    assert r.n == 100_000 and [(t.x, t.id) for t in r.top] == [(96, 96), (96, 193), (96, 290)]


def test_empty_input_and_bad_orders(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert listed(df, [("x", "desc"), ("id", "asc")], 3).count() == 0
    with pytest.raises(TypeError):
        top_k_list(df, [("note", "desc")], 3)
    with pytest.raises(ValueError):
        top_k_list(df, [("x", "down")], 3)


def test_stream_lists_follow_the_rows(spark, tmp_path):
    """After each run the lists are those of all rows so far, also of groups
    without new rows; a restarted query goes on from its state."""
    order, seen = [("x", "desc"), ("id", "asc")], []
    cols = ["g", "x", "id", "note", "rank"]
    for part in range(3):
        rows = [r for r in rows_of(50 + part, 200) if part != 1 or r[0] == 2]
        rows = [(*r[:3], r[3] + 1000 * part, r[4]) for r in rows]
        seen += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        q = stream_top_k(stream, ["g"], order, 4, str(tmp_path / "out"), str(tmp_path / "state"), ["note"], once=True)
        assert q.awaitTermination(120)
        want = top_k(spark.createDataFrame(seen, SCHEMA), "g", as_columns(order), 4)
        assert tuples(read_top_k(spark, str(tmp_path / "out"), ["g"]), cols) == tuples(want, cols)
