"""Quality flags and the reliability rule.

A cell that rests on few observations is published without its value, or with a
flag.  Both limits are parameters of the panel and are judged cell by cell, so the
rule means the same at every size; zero switches it off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FLAG_BELOW, FLAG_UNRELIABLE, SUPPRESS_BELOW


def reliable_expr(flag: str = "quality_flag", value: str = "pct",
                  unreliable: str = FLAG_UNRELIABLE) -> Column:
    """is_reliable = NOT (flag = 'u' OR value IS NULL), never NULL itself."""
    return ~((F.coalesce(F.col(flag), F.lit("")) == F.lit(unreliable)) | F.col(value).isNull())


def flag_small_cells(cells: DataFrame, suppress_below: int = SUPPRESS_BELOW, flag_below: int = FLAG_BELOW,
                     size: str = "n", value: str = "pct") -> DataFrame:
    """Adds ``quality_flag`` and ``is_reliable``: cells of under ``flag_below`` observations
    are flagged, those of under ``suppress_below`` lose their value too."""
    small = F.col(size) < F.lit(max(flag_below, suppress_below))
    out = (cells.withColumn(value, F.when(F.col(size) >= F.lit(suppress_below), F.col(value)))
           .withColumn("quality_flag", F.when(small, F.lit(FLAG_UNRELIABLE))))
    return out.withColumn("is_reliable", reliable_expr("quality_flag", value))
