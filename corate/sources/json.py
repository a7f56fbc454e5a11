"""JSON-lines review reader.

Only the three used fields are declared, so the JSON scan parses nothing
else (the pruned schema is the projection). Rows missing any of them are
dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("overall", T.DoubleType()),
])

_FIELDS = [f.name for f in REVIEW_SCHEMA.fields]


def read_reviews(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """``(reviewerID, asin, overall)`` from JSON-lines files. An
    ``observation`` receives ``n_lines`` and ``n_parsed`` from the same scan."""
    df = spark.read.schema(REVIEW_SCHEMA).option("mode", "PERMISSIVE").json(path)
    if observation is not None:
        known = F.lit(True)
        for f in _FIELDS:
            known = known & F.col(f).isNotNull()
        df = df.observe(observation, F.count(F.lit(1)).alias("n_lines"), F.count_if(known).alias("n_parsed"))
    return df.dropna(subset=_FIELDS)


def parse_reviews(df: DataFrame, col: str | Column = "value") -> DataFrame:
    """The same projection from a string column holding one JSON object."""
    c = F.col(col) if isinstance(col, str) else col
    # a generator is evaluated once per row; a struct's fields would be
    # pushed into the filter, with a parse for each
    return df.select(F.inline(F.array(F.from_json(c, REVIEW_SCHEMA)))).dropna(subset=_FIELDS)
