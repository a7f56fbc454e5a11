"""Column-expression building blocks (pure ``pyspark.sql.functions``)."""

from corate.functions.measures import (  # noqa: F401
    agreement, bucket_jaccard, cosine,
    fixed_point, l1_from_overlap, nonneg_zero, pearson_from_sums, ratio_or_zero,
)
from corate.functions.parsing import (  # noqa: F401
    fields_any_space, fields_single_space, to_double, to_long,
)
