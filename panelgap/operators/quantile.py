"""Exact quantiles without collecting a group into one task.

``percentile``/``median`` keep every value of a group in one aggregation
buffer; for a global quantile that is the whole column in one task.  Here the
column is ordered with the distributed row number and only the (at most two)
rows that straddle the quantile position are kept, then interpolated linearly
(same definition as ``quantile_cont`` / ``percentile``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank import global_row_number


def exact_quantile(df: DataFrame, value: str, q: float, out: str = "q") -> DataFrame:
    """One-row DataFrame with the exact ``q`` quantile of non-null ``value``."""
    v = df.where(F.col(value).isNotNull()).select(value, F.monotonically_increasing_id().alias("_salt"))
    # ``_salt`` lets the range partitioner split a value held by many rows;
    # the quantile depends only on the multiset of values, so which tied row
    # takes which position is irrelevant (the checkpoint fixes one order)
    rn = global_row_number(v, [F.col(value).asc(), F.col("_salt").asc()], "_rn")
    n = rn.agg(F.count(F.lit(1)).alias("n")).scalar()
    pos = (n - F.lit(1)) * F.lit(float(q))          # 0-based fractional position
    lo = F.floor(pos) + F.lit(1)
    hi = F.ceil(pos) + F.lit(1)
    near = (rn.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_fr", pos - F.floor(pos))
            .where((F.col("_rn") == F.col("_lo")) | (F.col("_rn") == F.col("_hi"))))
    a = F.max(F.when(F.col("_rn") == F.col("_lo"), F.col(value)))
    b = F.max(F.when(F.col("_rn") == F.col("_hi"), F.col(value)))
    return near.agg((a + (b - a) * F.max("_fr")).alias(out))
