"""The pipeline against SQL and brute force, stage by stage."""

import duckdb
from corpus_brute import groups, leaking_items, line_dedup, shingle_set

import corpus_pipeline
from corate.llm import mixing, quality
from corate.session import materialize

SF = "/root/testdata/sf0.001"


def test_pipeline_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF), name))
    rows = [[(r.doc_id, r.text) for r in d.orderBy("doc_id").collect()] for d in kept[:-1]]
    assert all(d.columns == columns for d in kept[:-1])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = {i for i, k in con.execute(f"SELECT doc_id, kept FROM ({quality.SQL})").fetchall() if k}
    assert rows[1] == [r for r in rows[0] if r[0] in good]
    assert rows[2] == [(i, "\n".join(x)) for (i, _), x in zip(rows[1], line_dedup(rows[1]), strict=True)]
    sets = [shingle_set(t) for _, t in rows[2]]
    seen, first = set(), []
    for r, s, c in zip(rows[2], sets, groups(sets), strict=True):
        if not s or c not in seen:
            first.append(r)
        seen.add(c)
    assert rows[3] == first
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows[4] == [r for r in rows[3] if not leaking_items(r[1], items)]
    last = kept[-2].toPandas()  # noqa: F841  read by the query below
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM last")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({mixing.SQL}) ORDER BY doc_id").fetchall()
    got = [tuple(r) for r in kept[-1].select(*names).orderBy("doc_id").collect()]
    assert got == want and len(got) > 100


def _odd_documents(prose):
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(prose)]
    rows += [rows[0]] * 3  # repeated rows
    rows += [(20, prose[1], "en", None, None), (None, prose[2] + " and back again", None, "s1", 0), (21, None, None, None, None),
             (22, "", "de", "s0", 0), (23, "\n\n \n", "de", "s0", 4), (24, "word " * 60_000, "en", "s0", 1)]
    return rows


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, empty, repeated and long texts, extra columns
    with names that the stages use."""
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    good = quality.keep_good(spark.read.parquet(f"{SF}/documents.parquet"))
    prose = [r.text for r in good.where("length(text) BETWEEN 400 AND 4000").orderBy("doc_id").limit(6).collect()]
    docs = spark.createDataFrame(_odd_documents(prose), kinds)
    wide = docs.selectExpr("*", "doc_id AS row", "1 AS size", "text AS v", "2 AS kept", "3 AS node", "4 AS version", "5 AS d")
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, ""), (2, "none of these words stands in any document of this test so nothing leaks")],
                          "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], str(tmp_path)), name))
    assert all(k.columns == wide.columns for k in kept[:-1])
    after_quality = [r.doc_id for r in kept[1].collect()]
    assert sorted(i for i in after_quality if i is not None) == [0, 0, 0, 0, 1, 2, 3, 4, 5, 20]
    assert None in after_quality
    left = {}
    for r in kept[3].collect():
        left.setdefault(r.doc_id, []).append(r.text)
    assert len(left[0]) == 1  # one of the equal rows
    assert all(len(left[i]) == 1 for i in (1, 2, 3, 4, 5))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert sorted(map(str, got.collect())) == sorted(map(str, kept[-1].collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
