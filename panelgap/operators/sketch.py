"""Approximate distinct counts of every cell of the cube.

Distinct counts don't add up: the orders of a nation that are in level A or R are not the
sum of both.  A HyperLogLog sketch of each pre-aggregated group merges instead, so one
scan and one small shuffle of sketches give the distinct count of every cell, of the
aggregate level and of the aggregate entity, at any number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .panel import category_code_expr, cell_rows

#: 2**14 registers: 16 KB a sketch at most, standard error 0.8 %.
LG_K = 14
#: Standard errors that the stated bound allows.
SIGMAS = 5


def relative_bound(lg_k: int = LG_K, sigmas: float = SIGMAS) -> float:
    """How far an estimate lies from the exact count at most, as a share of it."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def sketch_groups(micro: DataFrame, value: str, keys: Sequence[str] = ("entity", "rf", "ls", "os"), lg_k: int = LG_K) -> DataFrame:
    """One sketch of ``value`` a group, merged map-side first; null values don't count."""
    return micro.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), lg_k).alias("sketch"))


def sketch_cube(groups: DataFrame, **limits) -> DataFrame:
    """The sketch of every cell: ``entity, category_code, level, ls, os, sketch``."""
    return (cell_rows(groups, ["sketch"], **limits).groupBy("entity", "level", "ls", "os")
            .agg(F.hll_union_agg("sketch").alias("sketch"))
            .withColumn("category_code", category_code_expr()))


def approximate_distinct(cube: DataFrame, out: str = "approx_n") -> DataFrame:
    return cube.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def exact_distinct(micro: DataFrame, value: str, out: str = "exact_n", **limits) -> DataFrame:
    """The exact count of every cell, for an audit.  A value counts once in each cell that one of its groups belongs
    to, so the values with the same set of groups are counted first, and only these counts go up the cube."""
    group = F.struct("entity", "rf", "ls", "os")
    sets = (micro.where(F.col(value).isNotNull()).groupBy(value).agg(F.sort_array(F.collect_set(group)).alias("_set"))
            .groupBy("_set").agg(F.count(F.lit(1)).alias("_n")))
    groups = sets.select("_set", "_n", F.explode("_set").alias("_g")).select("_g.*", "_set", "_n")
    return (cell_rows(groups, ["_set", "_n"], **limits).distinct().groupBy("entity", "level", "ls", "os")
            .agg(F.sum("_n").alias(out)).withColumn("category_code", category_code_expr()))
