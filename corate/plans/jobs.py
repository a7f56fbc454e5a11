"""Composite jobs C1-C8 as ``spark-submit`` entry points.

    spark-submit -m corate.plans.jobs <job> [options]     (or python -m ...)

Inputs are rating triples as text (``user item rating``) or Parquet
(``user_id, item_id, rating``); outputs are Parquet unless a text format is
the job's product (index files, recommendation lines). Cluster settings
(master, memory, checkpoint folder) come from ``spark-submit``; nothing is
hard-wired here.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.operators import evaluate, indexing
from corate.operators.clean import dedup_ratings
from corate.operators.item_similarity import MEASURES, item_neighbours
from corate.operators.pair_similarity import pair_similarity
from corate.operators.recommend import item_based_recommend, vote_recommend
from corate.operators.split import active_users, holdout, holdout_users
from corate.operators.user_knn import QUERY, agreement_knn, l1_knn
from corate.functions.parsing import finite
from corate.session import DEFAULT_CONF, discard_run, ensure_checkpoint_dir, materialize
from corate.sinks.stores import read_bucketed, write_bucketed
from corate.sinks.text import index_lines, recommendation_lines, triple_lines, write_lines, \
    write_parquet
from corate.sources.json import read_reviews
from corate.sources.text import (read_index, read_neighbours, read_recommendation_lines,
                                 read_triples, read_user_list)


def load_ratings(spark: SparkSession, path: str, fmt: str = "auto",
                 mode: str = "whitespace") -> DataFrame:
    """Ratings from Parquet or triple text, finite ones, one row per (user,
    item); written once, since every job reads them several times. Counts of
    good and bad lines come from that one scan and are reported."""
    seen = Observation("ratings")
    if fmt == "parquet" or (fmt == "auto" and path.rstrip("/").endswith(".parquet")):
        df = spark.read.parquet(path).select(USER, ITEM, finite(F.col(RATING).cast("double")).alias(RATING))
        known = F.col(USER).isNotNull() & F.col(ITEM).isNotNull() & F.col(RATING).isNotNull()
        df = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(known).alias("n_parsed")).dropna()
    else:
        df = read_triples(spark, path, mode=mode, observation=seen)
    ratings = materialize(dedup_ratings(df), "ratings")
    report(path, seen.get)
    return ratings


def report(path: str, counts: dict) -> None:
    """One JSON line on standard error: a read input and its counts."""
    print(json.dumps({"input": path, **counts}), file=sys.stderr)


def etl(spark, a):
    """JSON reviews -> user/item index files + encoded triples."""
    # parsed once: read by both index builds and the encoding
    seen = Observation("reviews")
    reviews = materialize(read_reviews(spark, a.input, seen), "reviews")
    report(a.input, seen.get)
    # an earlier index keeps its ids, new keys follow
    ui = _index(spark, reviews, "reviewerID", a.user_index)
    ii = _index(spark, reviews, "asin", a.item_index)
    enc = indexing.encode(indexing.encode(reviews, ui, "reviewerID", USER), ii, "asin", ITEM)
    enc = materialize(enc.select(USER, ITEM, F.col("overall").alias(RATING)), "encoded")
    write_lines(index_lines(ui), f"{a.output}/user_index")
    write_lines(index_lines(ii), f"{a.output}/item_index")
    write_lines(triple_lines(enc), f"{a.output}/triples")
    write_parquet(enc, f"{a.output}/ratings.parquet")


def _index(spark, reviews, key, path):
    if not path:
        return indexing.build_index(reviews, key)
    return materialize(indexing.extend_index(materialize(read_index(spark, path), "old-index"), reviews, key), "index")


def item_neighbours_job(spark, a):
    """Top-k neighbour lists per item."""
    r = load_ratings(spark, a.input, a.format)
    lists = item_neighbours(r, a.measure, k=a.k, fill=not a.sparse)
    if a.buckets:
        write_bucketed(lists, a.output, ITEM, a.buckets)
    else:
        write_parquet(lists, a.output)


def pair_similarity_job(spark, a):
    """Pearson, cosine and rating-bucket Jaccard of co-rated pairs."""
    write_parquet(pair_similarity(load_ratings(spark, a.input, a.format)), a.output)


def recommend_knn(spark, a):
    """C4: user kNN votes for a list of users -> ``name: item item ...`` lines."""
    r = load_ratings(spark, a.input, a.format)
    ui, ii = read_index(spark, a.user_index), read_index(spark, a.item_index)
    names = read_user_list(spark, a.users)
    q = indexing.encode(names.withColumnRenamed("key", "name"), ui, "name", USER, index_key="key")
    knn = (l1_knn(r, q, a.k) if a.measure == "l1" else agreement_knn(r, q, a.k, fill=not a.sparse))
    votes = vote_recommend(knn, r, a.n)
    named = indexing.decode(votes.withColumnRenamed(QUERY, USER), ui, USER, "key")
    named = indexing.decode(named, ii, ITEM, "item_key")
    write_lines(recommendation_lines(named, users=names), a.output)


def holdout_job(spark, a):
    """Hold out the k lowest item ids of the n most active users."""
    r = load_ratings(spark, a.input, a.format)
    test, train = holdout(r, active_users(r, a.users).select(USER), a.k)
    write_parquet(test, f"{a.output}/test.parquet")
    write_parquet(train, f"{a.output}/train.parquet")
    write_lines(triple_lines(test), f"{a.output}/test_triples")
    if a.user_index:
        ui = read_index(spark, a.user_index)
        names = indexing.decode(holdout_users(test), ui, USER, "value")
        write_lines(names, f"{a.output}/test_user_names")


def evaluate_item(spark, a):
    """Item-based top-n on train, scored against the held-out set."""
    r = load_ratings(spark, a.input, a.format)
    test_users = active_users(r, a.users).select(USER)
    test, train = (materialize(x, "split") for x in holdout(r, test_users, a.k))
    history = train.join(test_users, USER, "left_semi")
    if a.stored:  # lists written by item-neighbours, as the reference reads them
        nb = read_bucketed(spark, a.stored, ITEM, a.buckets) if a.buckets else read_neighbours(spark, a.stored)
    else:
        nb = item_neighbours(train, a.measure, k=a.neighbours, fill=not a.sparse, items=history)
    top = item_based_recommend(history, nb, a.n, stored=bool(a.stored and a.buckets))
    per = (evaluate.euclidean_per_user(top, test) if a.metric == "euclidean"
           else evaluate.jaccard_per_user(top, test))
    value = "error" if a.metric == "euclidean" else "jaccard"
    _result(evaluate.mean_metric(per, value, test), a.output)


def _result(metric: DataFrame, output: str | None) -> None:
    """Prints the metric's row; with ``output`` it is stored too (Parquet)."""
    metric = materialize(metric, "metric")
    metric.show(truncate=False)
    if output:
        write_parquet(metric, output)


def evaluate_knn(spark, a):
    """Recommendation file vs held-out triples, mean Jaccard."""
    ui, ii = read_index(spark, a.user_index), read_index(spark, a.item_index)
    rec = read_recommendation_lines(spark, a.recommendations)
    rec = indexing.encode(indexing.encode(rec, ui, "key", USER), ii, "item_key", ITEM,
                          index_key="key")
    seen = Observation("held-out")
    test = materialize(read_triples(spark, a.test, mode="whitespace", observation=seen), "held-out")
    report(a.test, seen.get)
    per = evaluate.jaccard_per_user(rec.select(USER, ITEM), test)
    _result(evaluate.mean_metric(per, "jaccard", test), a.output)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="corate.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)

    def job(name, fn, *args):
        p = sub.add_parser(name)
        p.set_defaults(fn=fn)
        p.add_argument("--format", default="auto", choices=["auto", "text", "parquet"])
        for spec in args:
            flags, kw = spec
            p.add_argument(*flags, **kw)
        return p

    io = [(["input"], {}), (["output"], {})]
    store = (["--output"], {"default": None, "help": "store the metric's row here (Parquet)"})
    buckets = (["--buckets"], {"type": int, "default": 0, "help": "lists are bucketed by item, this many buckets"})
    job("etl", etl, *io,
        (["--user-index"], {"default": None, "help": "an earlier index: its ids stay, new keys follow"}),
        (["--item-index"], {"default": None, "help": "likewise for items"}))
    job("item-neighbours", item_neighbours_job, *io,
        (["--measure"], {"default": "cosine", "choices": MEASURES}),
        (["--k"], {"type": int, "default": 100}), buckets,
        (["--sparse"], {"action": "store_true", "help": "co-rated pairs only, no zero fill"}))
    job("pair-similarity", pair_similarity_job, *io)
    job("recommend-knn", recommend_knn, (["users"], {}), (["input"], {}), (["user_index"], {}),
        (["item_index"], {}), (["output"], {}),
        (["--measure"], {"default": "agreement", "choices": ["agreement", "l1"]}),
        (["--k"], {"type": int, "default": 100}), (["--n"], {"type": int, "default": 5}),
        (["--sparse"], {"action": "store_true", "help": "only users sharing an item"}))
    job("holdout", holdout_job, *io, (["--users"], {"type": int, "default": 25}),
        (["--k"], {"type": int, "default": 10}), (["--user-index"], {"default": None}))
    job("evaluate-item", evaluate_item, (["input"], {}), store, buckets,
        (["--metric"], {"default": "euclidean", "choices": ["euclidean", "jaccard"]}),
        (["--measure"], {"default": "cosine", "choices": MEASURES}),
        (["--users"], {"type": int, "default": 10}), (["--k"], {"type": int, "default": 10}),
        (["--n"], {"type": int, "default": 10}), (["--neighbours"], {"type": int, "default": 100}),
        (["--stored"], {"default": None, "help": "Parquet neighbour lists to use instead"}),
        (["--sparse"], {"action": "store_true"}))
    job("evaluate-knn", evaluate_knn, (["test"], {}), (["recommendations"], {}), store,
        (["user_index"], {}), (["item_index"], {}))
    a = ap.parse_args(argv)
    builder = SparkSession.builder.appName(f"corate-{a.job}")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        a.fn(spark, a)
    finally:
        discard_run(spark)


if __name__ == "__main__":
    main()
