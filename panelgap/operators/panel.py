"""F1: build the grouping-sets panel from microdata.

The reference ships a pre-computed cube (level, sex x level, age x level, plus
an aggregate level and a benchmark entity that is a roll-up of all entities).
Here the cube is *produced* from detail rows:

1. partial + final aggregation of the detail rows to
   (entity, raw level, axis values) -> (n, hits)   -- map-side combine, so a
   hot entity never reaches one task as raw rows;
2. a bounded Expand of those groups (x2 for the aggregate entity, x2 for the
   aggregate level, x(1 + #axes) for the grouping sets);
3. a second aggregation over the expanded groups.

Both shuffles carry groups, not rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (AGE_PREFIX, AGGREGATE_ENTITY, AGGREGATE_LEVEL, AGGREGATE_LEVEL_MEMBERS,
                      RETURNFLAG_LEVEL, SEX_PREFIX, TOTAL)


def _map_expr(col: str, mapping: Mapping[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def category_code_expr(level: str = "level", axes: Sequence[tuple[str, str]] = (("ls", SEX_PREFIX), ("os", AGE_PREFIX)),
                       total: str = TOTAL) -> Column:
    """Code of a cube cell: ``<prefix><axis value>_`` of the broken-down axis + level."""
    prefix = None
    for col, pre in axes:
        cond = F.col(col) != F.lit(total)
        val = F.concat(F.lit(pre), F.col(col), F.lit("_"))
        prefix = F.when(cond, val) if prefix is None else prefix.when(cond, val)
    prefix = prefix.otherwise(F.lit("")) if prefix is not None else F.lit("")
    return F.concat(prefix, F.col(level))


def pre_aggregate(micro: DataFrame, entity: str = "entity", raw_level: str = "rf",
                  axis_cols: Sequence[str] = ("ls", "os"), hit: str = "hit") -> DataFrame:
    """Detail rows -> (entity, raw level, axis values, n, hits): partial +
    final aggregation, so skew in any key is absorbed map-side."""
    return (micro.groupBy(entity, raw_level, *axis_cols)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("long").alias("hits")))


def cell_rows(groups: DataFrame, measures: Sequence[str], entity: str = "entity", raw_level: str = "rf",
              axes: Sequence[tuple[str, str]] = (("ls", SEX_PREFIX), ("os", AGE_PREFIX)),
              level_map: Mapping[str, str] = RETURNFLAG_LEVEL,
              aggregate_level: str | None = AGGREGATE_LEVEL,
              aggregate_members: Sequence[str] = AGGREGATE_LEVEL_MEMBERS,
              aggregate_entity: str | None = AGGREGATE_ENTITY,
              total: str = TOTAL, wanted_levels: Sequence[str] | None = None,
              breakdowns: Sequence[str] | None = None) -> DataFrame:
    """Each pre-aggregated group once for every cell of the cube that it belongs to, with its
    ``measures``: what any mergeable aggregate is then united from.

    ``wanted_levels`` and ``breakdowns`` (axes to break down by; none for the totals
    alone) limit the cube before it is expanded; the filter reaches the scan."""
    axis_cols = [a for a, _ in axes]
    if wanted_levels is not None:
        level_map = {raw: lv for raw, lv in level_map.items()
                     if lv in wanted_levels or (aggregate_level in wanted_levels and raw in aggregate_members)}
        groups = groups.where(F.col(raw_level).isin(*level_map))
    lvl = _map_expr(raw_level, level_map)
    if wanted_levels is not None and aggregate_level not in wanted_levels:
        levels = F.array(lvl)
    elif aggregate_level is not None:
        levels = F.when(F.col(raw_level).isin(*aggregate_members),
                        F.array(lvl, F.lit(aggregate_level))).otherwise(F.array(lvl))
    else:
        levels = F.array(lvl)
    ents = (F.array(F.col(entity), F.lit(aggregate_entity)) if aggregate_entity is not None
            else F.array(F.col(entity)))
    # grouping sets: level only, then level x each axis
    sets = [F.struct(*[F.lit(total).alias(a) for a in axis_cols])]
    for keep in axis_cols if breakdowns is None else breakdowns:
        sets.append(F.struct(*[(F.col(a) if a == keep else F.lit(total)).alias(a) for a in axis_cols]))

    expanded = (groups
                .select(F.explode(ents).alias("_e"), raw_level, *axis_cols, *measures)
                .select("_e", F.explode(levels).alias("_l"), *axis_cols, *measures))
    if wanted_levels is not None:
        expanded = expanded.where(F.col("_l").isin(*wanted_levels))
    return (expanded
            .select("_e", "_l", F.explode(F.array(*sets)).alias("_s"), *measures)
            .select(F.col("_e").alias(entity), F.col("_l").alias("level"),
                    *[F.col(f"_s.{a}").alias(a) for a in axis_cols], *measures))


def expand_cube(groups: DataFrame, entity: str = "entity", raw_level: str = "rf",
                axes: Sequence[tuple[str, str]] = (("ls", SEX_PREFIX), ("os", AGE_PREFIX)),
                aggregate_entity: str | None = AGGREGATE_ENTITY, total: str = TOTAL, **limits) -> DataFrame:
    """Pre-aggregated groups -> cube cells (bounded Expand + one aggregation); ``limits`` as in ``cell_rows``."""
    axis_cols = [a for a, _ in axes]
    expanded = cell_rows(groups, ["n", "hits"], entity, raw_level, axes, aggregate_entity=aggregate_entity, total=total, **limits)
    cells = (expanded.groupBy(entity, "level", *axis_cols)
             .agg(F.sum("n").cast("long").alias("n"), F.sum("hits").cast("long").alias("hits")))
    is_agg = (F.col(entity) == F.lit(aggregate_entity)) if aggregate_entity is not None else F.lit(False)
    return cells.select(
        F.col(entity),
        is_agg.alias("is_aggregate"),
        category_code_expr("level", axes, total).alias("category_code"),
        "level", *axis_cols, "n", "hits",
        (F.lit(100.0) * F.col("hits").cast("double") / F.col("n").cast("double")).alias("pct"),
    )


def build_panel(micro: DataFrame, entity: str = "entity", raw_level: str = "rf",
                axes: Sequence[tuple[str, str]] = (("ls", SEX_PREFIX), ("os", AGE_PREFIX)),
                hit: str = "hit", **kw) -> DataFrame:
    """Cells (entity, is_aggregate, category_code, level, <axes>, n, hits, pct).

    ``pct = 100 * hits / n`` as DOUBLE.  One cell per (entity, level) for the
    level set and per (entity, level, axis value) for each axis; the axes are
    never crossed with each other, matching the reference cube."""
    groups = pre_aggregate(micro, entity, raw_level, [a for a, _ in axes], hit)
    return expand_cube(groups, entity, raw_level, axes, **kw)
