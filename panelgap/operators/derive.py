"""Derived fact columns.

* ``gap_vs_ref``  = value of the reference level for the same entity and axis
  values minus the cell's value.  Computed with a window partitioned by
  (entity, axes): each window partition holds at most #levels rows, so there
  is no fan-out and no second scan; it equals the left self-join form.
* ``pct_vs_bench`` = cell value minus the benchmark entity's value of the same
  (level, axes).  The benchmark slice has at most one row per category code
  (bounded by the dimension, not by the data) and is broadcast.
* ``pct_excluded`` = 100 - value.
All three are rounded to 4 dp as the reference stores them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def derive_gaps(fact: DataFrame, ref_level: str = "L_NONE", bench_entity: str = "ALL",
                entity: str = "entity", level: str = "level", axes: Sequence[str] = ("ls", "os"),
                value: str = "pct", digits: int = 4, method: str = "window") -> DataFrame:
    v = F.col(value)
    if method == "window":
        w = Window.partitionBy(entity, *axes)
        ref = F.max(F.when(F.col(level) == F.lit(ref_level), v)).over(w)
        out = fact.withColumn("_ref", ref)
    elif method == "join":
        r = (fact.where(F.col(level) == F.lit(ref_level))
             .select(entity, *axes, v.alias("_ref")))
        out = fact.join(r, [entity, *axes], "left")
    else:
        raise ValueError(method)
    bench = F.broadcast(fact.where(F.col(entity) == F.lit(bench_entity))
                        .select(level, *axes, v.alias("_bench")))
    out = out.join(bench, [level, *axes], "left")
    return (out.withColumn("pct_excluded", F.round(F.lit(100.0) - v, digits))
            .withColumn("gap_vs_ref", F.round(F.col("_ref") - v, digits))
            .withColumn("pct_vs_bench", F.round(v - F.col("_bench"), digits))
            .drop("_ref", "_bench"))
