"""Readers and writers: edge lines, round trips."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import ratings_df
from corate.operators.indexing import extend_index
from corate.operators.recommend import item_based_recommend, predict_ratings
from corate.session import ensure_checkpoint_dir, materialize
from corate.sinks.stores import read_bucketed, write_bucketed
from corate.sinks.text import (index_lines, recommendation_lines, triple_lines,
                               write_lines)
from corate.sources.json import parse_reviews, read_reviews
from corate.sources.text import (parse_index, parse_recommendation_lines, parse_triples,
                                 read_index, read_triples, read_user_list, triple_line_counts)

EDGE_LINES = [
    "270 368 5.000000",      # good
    "1 2",                   # 2 fields
    "1 2 3 4",               # 4 fields
    "7  8 3.0",              # double space
    "9 10 4.0 ",             # trailing space
    "",                      # empty line
    "11 12 abc",             # non-numeric rating
    "007 0012 2.5",          # leading zeros
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_strict_triples_keep_only_three_single_space_fields(spark):
    got = sorted(tuple(r) for r in parse_triples(lines(spark, EDGE_LINES), "strict").collect())
    assert got == [(7, 12, 2.5), (270, 368, 5.0)]


def test_whitespace_triples_ignore_extra_fields(spark):
    got = sorted(tuple(r) for r in parse_triples(lines(spark, EDGE_LINES), "whitespace").collect())
    assert got == [(1, 2, 3.0), (7, 8, 3.0), (7, 12, 2.5), (9, 10, 4.0), (270, 368, 5.0)]


def test_truncate_floors_rating(spark):
    got = parse_triples(lines(spark, ["1 2 4.7"]), truncate=True).collect()
    assert got[0]["rating"] == 4.0


def test_index_keeps_string_keys_and_two_fields(spark):
    df = parse_index(lines(spark, ["0385 3", "A1 0", "bad line here", "B2 x", ""]))
    assert sorted(tuple(r) for r in df.collect()) == [("0385", 3), ("A1", 0)]


def test_the_last_index_line_of_a_key_wins(spark):
    df = parse_index(lines(spark, ["A 1", "B 7", "A 2"]).coalesce(1))
    assert sorted(tuple(r) for r in df.collect()) == [("A", 2), ("B", 7)]


def test_numbers_that_are_not_finite_are_rejected_and_counted(spark):
    rows = lines(spark, ["1 2 3.0", "1 2 NaN", "1 2 Infinity", "1 2 -inf", "1 x 3", "1  2 3", "1 2", "1 2 4.5"])
    assert sorted(tuple(r) for r in parse_triples(rows).collect()) == [(1, 2, 3.0), (1, 2, 4.5)]
    assert tuple(triple_line_counts(rows).first()) == (8, 2, 2, 4)
    assert tuple(triple_line_counts(rows, "whitespace").first()) == (8, 3, 1, 4)
    assert tuple(triple_line_counts(rows.limit(0)).first()) == (0, 0, 0, 0)


def test_json_is_parsed_once(spark):
    df = parse_reviews(lines(spark, ['{"reviewerID": "u", "asin": "a", "overall": 4.0}', '{"asin": "b"}', "x"]))
    assert [tuple(r) for r in df.collect()] == [("u", "a", 4.0)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_users_without_recommendations_get_a_line(spark):
    recs = spark.createDataFrame([("U1", "B", 1)], "key string, item_key string, rank long")
    users = spark.createDataFrame([("U1",), ("U2",)], "key string")
    assert {r["key"]: r["value"] for r in recommendation_lines(recs, users=users).collect()} == \
        {"U1": "U1: B ", "U2": "U2: "}


def test_a_cluster_without_a_checkpoint_folder_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_recommendation_lines_round_trip(spark):
    recs = spark.createDataFrame(
        [("U1", "B", 2), ("U1", "A", 1), ("U2", "C", 1)], "key string, item_key string, rank long")
    out = {r["key"]: r["value"] for r in recommendation_lines(recs).collect()}
    assert out == {"U1": "U1: A B ", "U2": "U2: C "}
    back = parse_recommendation_lines(lines(spark, list(out.values())))
    assert sorted(tuple(r) for r in back.collect()) == [("U1", "A", 1), ("U1", "B", 2), ("U2", "C", 1)]


def test_text_files_round_trip(spark, tmp_path):
    r = spark.createDataFrame([(1, 2, 5.0), (3, 4, 1.5)], "user_id long, item_id long, rating double")
    assert sorted(v["value"] for v in triple_lines(r).collect()) == ["1 2 5.000000", "3 4 1.500000"]
    write_lines(triple_lines(r), str(tmp_path / "t"))
    back = read_triples(spark, str(tmp_path / "t"))
    assert sorted(tuple(x) for x in back.collect()) == [(1, 2, 5.0), (3, 4, 1.5)]
    ix = spark.createDataFrame([("A", 0), ("B", 1)], "key string, id long")
    assert sorted(v["value"] for v in index_lines(ix).collect()) == ["A 0", "B 1"]
    (tmp_path / "users.txt").write_text("A1\n\n B2 \n")
    assert [x["key"] for x in read_user_list(spark, str(tmp_path / "users.txt")).collect()] == ["A1", "B2"]


def test_json_reviews_project_three_fields(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text('{"reviewerID":"A","asin":"B","overall":5.0,"reviewText":"x"}\n'
                 '{"reviewerID":"C","asin":"D"}\n'
                 'not json\n'
                 '{"asin":"0012","overall":3.0,"reviewerID":"E","helpful":[1,2]}\n')
    got = sorted(tuple(r) for r in read_reviews(spark, str(p)).collect())
    assert got == [("A", "B", 5.0), ("E", "0012", 3.0)]
    df = lines(spark, ['{"reviewerID":"A","asin":"B","overall":4.0}'])
    assert [tuple(r) for r in parse_reviews(df).collect()] == [("A", "B", 4.0)]
    assert parse_reviews(df).columns == ["reviewerID", "asin", "overall"]
    assert read_reviews(spark, str(p)).select(F.col("overall")).dtypes == [("overall", "double")]


def test_index_lines_count_in_the_order_of_paths_and_offsets(spark, tmp_path):
    """Files of very different sizes in many splits: Spark scans the largest
    first, the last line is still that of the last path."""
    folder = tmp_path / "index"
    folder.mkdir()
    sizes = {"a.txt": 3000, "b.txt": 10, "c.txt": 900, "d.txt": 2}
    want = {}
    for n, (name, size) in enumerate(sizes.items()):
        rows = [(f"K{i % 500}", 10_000 * n + i) for i in range(size)]
        want.update(rows)
        (folder / name).write_text("".join(f"{k} {v}\n" for k, v in rows))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "7k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert {r.key: r.id for r in read_index(spark, str(folder)).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_a_growing_index_keeps_its_ids(spark):
    old = spark.createDataFrame([("B", 4), ("D", 0), ("0385", 9)], "key string, id long")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    got = {r.key: r.id for r in extend_index(old, names("A", "B", "C", "A", None, "0385"), "name").collect()}
    assert got == {"B": 4, "D": 0, "0385": 9, "A": 10, "C": 11}
    grown = spark.createDataFrame(list(got.items()), "key string, id long")
    assert {r.key: r.id for r in extend_index(grown, names("C", "A"), "name").collect()} == got
    assert {r.key: r.id for r in extend_index(old.limit(0), names("y", "x"), "name").collect()} == {"x": 0, "y": 1}


def test_line_counts_come_from_the_scan_that_parses(spark, tmp_path):
    (tmp_path / "t.txt").write_text("\n".join(EDGE_LINES) + "\n1 2 NaN\n")
    for mode in ("strict", "whitespace"):
        seen = Observation(f"lines {mode}")
        parsed = read_triples(spark, str(tmp_path / "t.txt"), mode, observation=seen)
        assert parsed._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
        rows = materialize(parsed, "observed").count()
        counts = triple_line_counts(spark.read.text(str(tmp_path / "t.txt")), mode).first().asDict()
        assert seen.get == counts and counts["n_parsed"] == rows


def test_bucketed_lists_are_joined_without_shuffling_them(spark, tmp_path):
    lists = spark.createDataFrame([(i, j, 1.0 / (1 + (i * j) % 7)) for i in range(40) for j in range(40, 45)],
                                  "item_id long, neighbour_id long, sim double")
    path = str(tmp_path / "lists")
    write_bucketed(lists, path, "item_id", 4)
    store = read_bucketed(spark, path, "item_id", 4)
    assert sorted(map(tuple, store.collect())) == sorted(map(tuple, lists.collect()))
    # item 3 is hot: its ratings are cut into blocks
    history = ratings_df(spark, [(u, i, 1 + (u + i) % 5) for u in range(60) for i in (3, u % 40, (u * 7) % 40 + 1) if i < 40]).distinct()
    history = history.dropDuplicates(["user_id", "item_id"])
    want = sorted(map(tuple, predict_ratings(history, lists).collect()))
    for limit in (1 << 20, 0):
        got = predict_ratings(history, store, block_rows=8, max_broadcast_bytes=limit, stored=True)
        assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    bucketed = [i for i, x in enumerate(plan.splitlines()) if "Bucketed: true" in x]
    assert bucketed
    from corate.operators import recommend
    cold = recommend._stored_join(history.withColumnRenamed("rating", "_r"), store.withColumnRenamed("sim", "_w"), "item_id",
                                  "user_id", 10_000, 0)
    text = cold._jdf.queryExecution().executedPlan().toString()
    join = text.split("Union")[-1] if "Union" not in text else text[text.index("SortMergeJoin"):]
    scan = join[:join.index("Bucketed: true")]
    last = scan.rindex("SortMergeJoin")
    side = [x for x in scan[last:].splitlines() if "FileScan" in x or "Exchange" in x]
    assert side and not any("Exchange" in x for x in side[: [i for i, x in enumerate(side) if "FileScan" in x][0]])
    top = item_based_recommend(history, store, 3, stored=True)
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, item_based_recommend(history, lists, 3).collect()))
