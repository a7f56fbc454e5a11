"""Corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark
decontamination, mixing of sources.

Each stage reads what its predecessor kept (written as Parquet in the shared
checkpoint folder and read again) and returns the documents it keeps, with
all columns of ``documents``; the last stage returns the mix. Defined results
for odd inputs are those of the operators, see their modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corate.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from corate.llm.common import table
from corate.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has."""
    return line_dedup.drop_repeated_lines(docs)


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (the smallest doc_id)."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: per document its size, its source's size and target, and the
    words taken."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("jaccard_join", jaccard_groups),
    ("decontamination", decontamination),
    ("mixing", mix_sources),
]

#: The n-gram join's components have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
