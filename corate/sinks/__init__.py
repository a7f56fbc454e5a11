"""Writers (K1-K8). Line builders return DataFrames of one ``value`` string
column, so the formatting runs inside Spark and ``write_lines`` writes them
in parallel (one file per partition) instead of through the driver."""

from corate.sinks.text import (  # noqa: F401
    index_lines, recommendation_lines, triple_lines, write_lines, write_parquet,
)
from corate.sinks.stores import read_bucketed, write_bucketed  # noqa: F401
