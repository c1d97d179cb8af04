"""Cell pivots and per-entity metrics.

The reference answers "value of cell a next to cell b for the same entity" with
one self-join per cell.  Here all requested cells come out of ONE conditional
aggregation keyed by entity: one shuffle of the (already small) fact, partial
aggregation absorbs any skew, and n self-joins become zero.

Inner-join semantics are kept explicitly: ``require`` lists cells that must be
*present* (a present cell whose value is NULL still yields a row, with NULL
arithmetic), which is exactly what the chained inner joins did.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SPEC, PanelSpec
from ..functions.bands import band_between
from ..functions.exprs import complement, diff
from .rank import rank_where


def cell_pivot(fact: DataFrame, cells: Mapping[str, str], keys: Sequence[str] = ("entity",),
               category: str = "category_code", value: str = "pct",
               reliable: str | None = "is_reliable", require: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``; for each alias -> code in ``cells`` the columns
    ``<alias>`` (value), ``<alias>_rel`` (reliability) and ``<alias>_n``
    (number of fact rows of that cell, 0 = absent)."""
    codes = list(cells.values())
    aggs = []
    for alias, code in cells.items():
        hit = F.col(category) == F.lit(code)
        aggs.append(F.max(F.when(hit, F.col(value))).alias(alias))
        if reliable is not None:
            aggs.append(F.max(F.when(hit, F.col(reliable).cast("int"))).alias(f"{alias}_rel_i"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"{alias}_n"))
    out = fact.where(F.col(category).isin(*codes)).groupBy(*keys).agg(*aggs)
    for alias in require:
        out = out.where(F.col(f"{alias}_n") > 0)
    if reliable is not None:
        for alias in cells:
            out = out.withColumn(f"{alias}_rel", F.col(f"{alias}_rel_i") == F.lit(1)).drop(f"{alias}_rel_i")
    return out


def require_reliable(piv: DataFrame, mode: str, left: str, right: str) -> DataFrame:
    """Which cells of a pair must be reliable: ``none``, ``right`` (the
    second cell, e.g. the severe level of a gap) or ``both``."""
    if mode == "none":
        return piv
    if mode == "right":
        return piv.where(F.col(f"{right}_rel"))
    if mode == "both":
        return piv.where(F.col(f"{left}_rel") & F.col(f"{right}_rel"))
    raise ValueError(f"require_reliable must be none, right or both, not {mode!r}")


def mart_cells(spec: PanelSpec = DEFAULT_SPEC) -> dict[str, str]:
    c = spec.code
    return {
        "pct_ref": c(spec.ref_level),
        "pct_sev": c(spec.severe_level),
        "pct_ltd": c("L_LTD"),
        "pct_ltd_sev": c("L_LTD_SEV"),
        "pct_female_sev": c(spec.severe_level, sex=spec.female),
        "pct_male_sev": c(spec.severe_level, sex=spec.male),
        "pct_mid_sev": c(spec.severe_level, age=spec.age_mid),
        "pct_old_sev": c(spec.severe_level, age=spec.age_old),
    }


# mart inclusion groups (the loader's rule: < low, > high, else)
MART_GROUPS = ("High inclusion", "Extreme case", "Medium inclusion")


def entity_metrics(fact: DataFrame, spec: PanelSpec = DEFAULT_SPEC,
                   low: float = 0.0, high: float = 4.0,
                   bench_gap: float | None = None) -> DataFrame:
    """A4 ``mart``: one wide row per entity.

    gap_total = ref - severe, gap_gender = male - female (severe),
    gap_age = mid - old (severe), all rounded to 2 dp; gap_vs_bench =
    gap_total - gap_total of the aggregate entity (computed from the data
    unless ``bench_gap`` overrides it); pct_excluded_sev = 100 - severe;
    inclusion_group by the mart rule (aggregate and NULL gap -> NULL);
    rank_by_gap = ordinal 1..n over non-aggregate entities with a gap,
    ties broken by entity code."""
    cells = mart_cells(spec)
    piv = cell_pivot(fact, cells, keys=("entity", "is_aggregate"), reliable=None)
    piv = piv.select("entity", "is_aggregate", *cells.keys())
    m = (piv.withColumn("gap_total", diff("pct_ref", "pct_sev"))
         .withColumn("gap_gender", diff("pct_male_sev", "pct_female_sev"))
         .withColumn("gap_age", diff("pct_mid_sev", "pct_old_sev")))
    if bench_gap is None:
        ref = m.where(F.col("entity") == F.lit(spec.aggregate_entity)).agg(F.max("gap_total"))
        bench = ref.scalar()
    else:
        bench = F.lit(float(bench_gap))
    m = (m.withColumn("gap_vs_bench", F.round(F.col("gap_total") - bench, 2))
         .withColumn("pct_excluded_sev", complement("pct_sev"))
         .withColumn("inclusion_group", band_between(
             "gap_total", low, high, *MART_GROUPS, guards=[(F.col("is_aggregate"), None)])))
    ranked = rank_where(m, (~F.col("is_aggregate")) & F.col("gap_total").isNotNull(),
                        "gap_total", "rank_by_gap", tiebreak=["entity"], method="row_number")
    return ranked


def derived_metrics_mean(fact: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """A5 (the helper's variant): *mean* per entity of the cells of each role
    (pivot_table default aggfunc), gaps rounded to 2 dp, and the position
    relative to the aggregate entity (NULL when the aggregate is absent)."""
    sev = spec.severe_level
    core = (F.col("ls") == "Total") & (F.col("os") == "Total")
    aggs = [
        F.avg(F.when(core & (F.col("level") == spec.ref_level), F.col("pct"))).alias("ref"),
        F.avg(F.when(core & (F.col("level") == sev), F.col("pct"))).alias("sev"),
        F.avg(F.when((F.col("level") == sev) & (F.col("ls") == spec.male), F.col("pct"))).alias("m_sev"),
        F.avg(F.when((F.col("level") == sev) & (F.col("ls") == spec.female), F.col("pct"))).alias("f_sev"),
        F.avg(F.when((F.col("level") == sev) & (F.col("os") == spec.age_mid), F.col("pct"))).alias("mid_sev"),
        F.avg(F.when((F.col("level") == sev) & (F.col("os") == spec.age_old), F.col("pct"))).alias("old_sev"),
    ]
    m = fact.groupBy("entity").agg(*aggs)
    m = (m.withColumn("gap_total", diff("ref", "sev")).withColumn("gap_gender", diff("m_sev", "f_sev"))
         .withColumn("gap_age", diff("mid_sev", "old_sev")))
    bench = m.where(F.col("entity") == F.lit(spec.aggregate_entity)).agg(F.max("gap_total")).scalar()
    return m.withColumn("pos_vs_bench", F.round(F.col("gap_total") - bench, 2))
