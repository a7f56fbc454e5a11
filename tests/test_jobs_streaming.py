"""Composite jobs end to end on temp folders; streaming ingest."""

from corate.plans import jobs
from corate.streaming import ingest_triples, read_triples_stream


def test_etl_then_item_neighbours_and_knn(spark, tmp_path):
    src = tmp_path / "reviews.json"
    src.write_text("\n".join(
        '{"reviewerID":"%s","asin":"%s","overall":%d.0,"reviewText":"t"}' % (u, i, r)
        for u, i, r in [("U1", "0A", 5), ("U1", "0B", 4), ("U2", "0A", 3), ("U2", "0C", 2),
                        ("U3", "0B", 5), ("U3", "0C", 1), ("U3", "0A", 4)]) + "\n")
    out = str(tmp_path / "etl")
    jobs.main(["etl", str(src), out])
    r = spark.read.parquet(f"{out}/ratings.parquet")
    assert r.count() == 7
    idx = sorted(x["value"] for x in spark.read.text(f"{out}/user_index").collect())
    assert idx == ["U1 0", "U2 1", "U3 2"]
    jobs.main(["item-neighbours", f"{out}/triples", str(tmp_path / "nb"), "--k", "2"])
    nb = spark.read.parquet(str(tmp_path / "nb"))
    assert nb.count() == 6
    (tmp_path / "users.txt").write_text("U1\nU2\n")
    jobs.main(["recommend-knn", str(tmp_path / "users.txt"), f"{out}/triples",
               f"{out}/user_index", f"{out}/item_index", str(tmp_path / "rec"),
               "--k", "2", "--n", "2"])
    lines = sorted(x["value"] for x in spark.read.text(str(tmp_path / "rec")).collect())
    assert [ln.split(":")[0] for ln in lines] == ["U1", "U2"]
    assert all(ln.endswith(" ") and len(ln.split()) == 3 for ln in lines)


def test_jobs_read_their_text_once_and_leave_no_intermediate_files(spark, tmp_path):
    import os

    from corate.session import run_dir

    rows = "\n".join(f"{u} {i} {1 + (u * i) % 5}" for u in range(12) for i in range(10) if (u + i) % 3) + "\n1 2 NaN\n"
    (tmp_path / "t.txt").write_text(rows)
    jobs.main(["item-neighbours", str(tmp_path / "t.txt"), str(tmp_path / "nb"), "--measure", "pearson", "--k", "3"])
    jobs.main(["evaluate-item", str(tmp_path / "t.txt"), "--users", "3", "--k", "2", "--n", "4",
               "--stored", str(tmp_path / "nb")])
    assert not os.path.exists(run_dir(spark).removeprefix("file:"))
    r = jobs.load_ratings(spark, str(tmp_path / "t.txt"))
    assert "parquet" in r._jdf.queryExecution().executedPlan().toString()
    assert r.where("isnan(rating)").count() == 0


def test_streaming_ingest_appends_parsed_triples(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.txt").write_text("1 2 5.0\nbad line\n3 4 2.0\n")
    q = ingest_triples(read_triples_stream(spark, str(inbox)), str(tmp_path / "table"),
                       str(tmp_path / "ckpt"), once=True)
    q.awaitTermination(120)
    got = sorted(tuple(x) for x in spark.read.parquet(str(tmp_path / "table")).collect())
    assert got == [(1, 2, 5.0), (3, 4, 2.0)]


def test_holdout_evaluations_and_pair_job(spark, tmp_path, capsys):
    import random
    rnd = random.Random(7)
    rows = []
    for u in range(10):
        for i in rnd.sample(range(12), 3 + u % 6):
            rows.append((f"U{u}", f"I{i:02d}", rnd.randint(1, 5)))
    src = tmp_path / "reviews.json"
    src.write_text("\n".join('{"reviewerID":"%s","asin":"%s","overall":%d.0}' % x
                             for x in rows) + "\n")
    out = str(tmp_path / "etl")
    jobs.main(["etl", str(src), out])
    ho = str(tmp_path / "ho")
    jobs.main(["holdout", f"{out}/triples", ho, "--users", "3", "--k", "2",
               "--user-index", f"{out}/user_index"])
    test = spark.read.parquet(f"{ho}/test.parquet")
    train = spark.read.parquet(f"{ho}/train.parquet")
    assert test.count() == 6 and train.count() + 6 == len(rows)
    assert train.join(test, ["user_id", "item_id"]).count() == 0
    assert spark.read.text(f"{ho}/test_user_names").count() == 3

    capsys.readouterr()
    jobs.main(["evaluate-item", f"{out}/triples", "--metric", "euclidean", "--users", "3",
               "--k", "2", "--n", "4", "--neighbours", "5"])
    shown = capsys.readouterr().out
    assert "n_users" in shown and "mean_error" in shown and "|3      |" in shown

    jobs.main(["recommend-knn", f"{ho}/test_user_names", f"{ho}/train.parquet",
               f"{out}/user_index", f"{out}/item_index", str(tmp_path / "rec"),
               "--k", "3", "--n", "4"])
    capsys.readouterr()
    jobs.main(["evaluate-knn", f"{ho}/test_triples", str(tmp_path / "rec"),
               f"{out}/user_index", f"{out}/item_index"])
    shown = capsys.readouterr().out
    assert "mean_jaccard" in shown and "|3      |" in shown

    jobs.main(["pair-similarity", f"{out}/triples", str(tmp_path / "pairs")])
    p = spark.read.parquet(str(tmp_path / "pairs"))
    assert p.count() > 0 and p.where("item_a >= item_b").count() == 0


def test_jobs_report_bad_lines_grow_an_index_and_store_results(spark, tmp_path, capsys):
    import json

    def reviews(name, rows):
        (tmp_path / name).write_text("\n".join('{"reviewerID":"%s","asin":"%s","overall":%d}' % x for x in rows) + "\nno json\n")
        return str(tmp_path / name)

    first = [(f"U{u}", f"I{i}", 1 + (u * i) % 5) for u in range(2, 9) for i in range(1, 9) if (u + i) % 3]
    jobs.main(["etl", reviews("a.json", first), str(tmp_path / "a")])
    assert '"n_lines": %d, "n_parsed": %d' % (len(first) + 1, len(first)) in capsys.readouterr().err
    more = first + [("U0", "I0", 3), ("U11", "I1", 2), ("U11", "I2", 4)]
    jobs.main(["etl", reviews("b.json", more), str(tmp_path / "b"), "--user-index", str(tmp_path / "a/user_index"),
               "--item-index", str(tmp_path / "a/item_index")])
    ids = lambda p: dict(r.value.split(" ") for r in spark.read.text(str(tmp_path / p)).collect())
    old, new = ids("a/user_index"), ids("b/user_index")
    assert old.items() <= new.items() and {new["U0"], new["U11"]} == {str(len(old)), str(len(old) + 1)}

    (tmp_path / "t.txt").write_text("\n".join(f"{new[u]} {i[1:]} {r}" for u, i, r in more) + "\n1 2\n1 2 NaN\n")
    capsys.readouterr()
    jobs.main(["item-neighbours", str(tmp_path / "t.txt"), str(tmp_path / "nb"), "--k", "5", "--buckets", "3"])
    seen = json.loads([x for x in capsys.readouterr().err.splitlines() if x.startswith('{"input"')][-1])
    assert (seen["n_lines"], seen["n_parsed"], seen["n_bad_fields"], seen["n_bad_numbers"]) == \
        (len(more) + 2, len(more), 1, 1)
    jobs.main(["item-neighbours", str(tmp_path / "t.txt"), str(tmp_path / "plain"), "--k", "5"])
    for stored in (["nb", "--buckets", "3"], ["plain"]):
        jobs.main(["evaluate-item", str(tmp_path / "t.txt"), "--users", "3", "--k", "2", "--n", "4", "--metric", "jaccard",
                   "--stored", str(tmp_path / stored[0]), *stored[1:], "--output", str(tmp_path / f"metric-{stored[0]}")])
    a, b = (spark.read.parquet(str(tmp_path / f"metric-{x}")).collect() for x in ("nb", "plain"))
    assert a == b and a[0].n_users == 3
