"""Named views (S8-S10), the remaining chart datasets (R1, R2), the paired
views of the seed script, the mean-preset metrics (A5) and the warehouse load
(S6, S7, S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_SPEC as S
from ..functions.exprs import diff, rnd
from ..operators.metrics import cell_pivot, derived_metrics_mean
from ..sources.sinks import write_one_csv
from ..sources.warehouse import Warehouse
from . import model
from . import oracle as O
from .queries import AGG, F_SEV, M_SEV, MID_SEV, OLD_SEV, REF, SEV, _total
from .registry import query

FOCUS = S.focus_entity


def _ent(spark, sf_dir):
    return F.broadcast(model.entities(spark, sf_dir))


# ------------------------------------------- paired views of the seed ----
def v_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    piv = cell_pivot(model.fact(spark, sf_dir), {"f": F_SEV, "m": M_SEV}, reliable=None, require=("f", "m"))
    return (piv.join(_ent(spark, sf_dir), "entity")
            .select("entity", "entity_name", rnd("f").alias("pct_female_sev"), rnd("m").alias("pct_male_sev"),
                    diff("m", "f").alias("gender_gap_pp"), F.abs(F.col("m") - F.col("f")).alias("_o"))
            .orderBy(F.col("_o").desc_nulls_last(), "entity").drop("_o"))


query("v_gender", O.with_fact(O.by_entity("pair", f=F_SEV, m=M_SEV) + """
SELECT entity, entity_name, ROUND(f, 2) AS pct_female_sev, ROUND(m, 2) AS pct_male_sev, ROUND(m - f, 2) AS gender_gap_pp
FROM pair JOIN dim_entity USING (entity)"""))(v_gender)


def v_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    piv = cell_pivot(model.fact(spark, sf_dir), {"a": MID_SEV, "b": OLD_SEV}, reliable=None, require=("a", "b"))
    return (piv.join(_ent(spark, sf_dir), "entity")
            .select("entity", "entity_name", rnd("a").alias("pct_mid_sev"), rnd("b").alias("pct_old_sev"),
                    diff("a", "b").alias("age_effect_pp"))
            .orderBy(F.col("age_effect_pp").desc_nulls_last(), "entity"))


query("v_age", O.with_fact(O.by_entity("pair", mid=MID_SEV, old=OLD_SEV) + """
SELECT entity, entity_name, ROUND(mid, 2) AS pct_mid_sev, ROUND(old, 2) AS pct_old_sev, ROUND(mid - old, 2) AS age_effect_pp
FROM pair JOIN dim_entity USING (entity)"""))(v_age)


# ------------------------------------------------------- chart R1 / R2 ----
def eda_ranking(spark: SparkSession, sf_dir: str, bench_default: float | None = None) -> DataFrame:
    """Gap (reference - severe, unrounded) per non-aggregate entity with
    both cells valued, ascending, with the benchmark's gap as a reference line
    (``bench_default`` when the benchmark is absent) and a highlight colour."""
    core = _total(model.fact(spark, sf_dir))
    piv = cell_pivot(core, {"a": REF, "b": SEV}, reliable=None)
    g = piv.select("entity", (F.col("a") - F.col("b")).alias("gap")).where(F.col("gap").isNotNull())
    bench = g.where(F.col("entity") == AGG).agg(F.max("gap")).scalar()
    if bench_default is not None:
        bench = F.coalesce(bench, F.lit(float(bench_default)))
    color = None
    for k, v in S.highlight.items():
        color = F.when(F.col("entity") == k, v) if color is None else color.when(F.col("entity") == k, v)
    color = color.otherwise(S.highlight_default)
    return (g.where(F.col("entity") != AGG).join(_ent(spark, sf_dir), "entity")
            .select("entity", "entity_name", "gap", bench.alias("bench_gap"), color.alias("bar_color"))
            .orderBy("gap", "entity"))


query("eda_ranking", O.with_fact(f"""
, rg AS (
  SELECT entity, MAX(CASE WHEN category_code = '{REF}' THEN pct END) - MAX(CASE WHEN category_code = '{SEV}' THEN pct END) AS gap
  FROM fact WHERE category_code IN ('{REF}', '{SEV}') GROUP BY entity)
SELECT g.entity, c.entity_name, g.gap, (SELECT MAX(gap) FROM rg WHERE entity = '{AGG}') AS bench_gap,
       CASE g.entity {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.highlight.items())}
            ELSE '{S.highlight_default}' END AS bar_color
FROM rg g JOIN dim_entity c ON g.entity = c.entity
WHERE g.gap IS NOT NULL AND g.entity <> '{AGG}'
ORDER BY g.gap"""))(eda_ranking)


def eda_focus_vs_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: focus and benchmark by level, re-indexed to the full ordered level
    list (a missing level gives NULLs): left join FROM the level dimension."""
    core = _total(model.fact(spark, sf_dir)).where(F.col("entity").isin(FOCUS, AGG))
    p = core.groupBy("level").agg(F.max(F.when(F.col("entity") == FOCUS, F.col("pct"))).alias("focus_pct"),
                                  F.max(F.when(F.col("entity") == AGG, F.col("pct"))).alias("bench_pct"))
    lv = F.broadcast(model.dim_level(spark))
    return (lv.join(p, "level", "left")
            .select("level", "level_label", F.col("level_order").cast("long").alias("level_order"),
                    "focus_pct", "bench_pct").orderBy("level_order"))


query("eda_focus_vs_bench", O.with_fact(f"""
SELECT dl.level, dl.level_label, CAST(dl.level_order AS BIGINT) AS level_order,
       MAX(CASE WHEN f.entity = '{FOCUS}' THEN f.pct END) AS focus_pct,
       MAX(CASE WHEN f.entity = '{AGG}' THEN f.pct END) AS bench_pct
FROM dim_level dl
LEFT JOIN fact f ON f.level = dl.level AND f.ls = 'Total' AND f.os = 'Total' AND f.entity IN ('{FOCUS}', '{AGG}')
GROUP BY dl.level, dl.level_label, dl.level_order
ORDER BY dl.level_order"""))(eda_focus_vs_bench)


# ------------------------------------------------- A5 mean-preset metrics --
def entity_metrics_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_metrics_mean(model.fact(spark, sf_dir), S).join(_ent(spark, sf_dir), "entity").select(
        "entity", "entity_name", "ref", "sev", "gap_total", "m_sev", "f_sev", "gap_gender", "mid_sev",
        "old_sev", "gap_age", "pos_vs_bench")


query("entity_metrics_mean", O.with_fact(f"""
, m0 AS (
  SELECT entity,
    AVG(CASE WHEN ls = 'Total' AND os = 'Total' AND level = '{S.ref_level}' THEN pct END) AS ref,
    AVG(CASE WHEN ls = 'Total' AND os = 'Total' AND level = '{S.severe_level}' THEN pct END) AS sev,
    AVG(CASE WHEN level = '{S.severe_level}' AND ls = '{S.male}' THEN pct END) AS m_sev,
    AVG(CASE WHEN level = '{S.severe_level}' AND ls = '{S.female}' THEN pct END) AS f_sev,
    AVG(CASE WHEN level = '{S.severe_level}' AND os = '{S.age_mid}' THEN pct END) AS mid_sev,
    AVG(CASE WHEN level = '{S.severe_level}' AND os = '{S.age_old}' THEN pct END) AS old_sev
  FROM fact GROUP BY entity),
m1 AS (SELECT *, ROUND(ref - sev, 2) AS gap_total, ROUND(m_sev - f_sev, 2) AS gap_gender,
              ROUND(mid_sev - old_sev, 2) AS gap_age FROM m0)
SELECT m1.entity, c.entity_name, ref, sev, gap_total, m_sev, f_sev, gap_gender, mid_sev, old_sev, gap_age,
       ROUND(gap_total - (SELECT MAX(gap_total) FROM m1 WHERE entity = '{AGG}'), 2) AS pos_vs_bench
FROM m1 JOIN dim_entity c ON m1.entity = c.entity"""))(entity_metrics_mean)


# ------------------------------------------------------- named views -----
VIEW_NAMES = {
    "v_full_dataset": "star_view", "v_ranking_gap": "v_ranking", "v_gender_sev": "v_gender",
    "v_age_sev": "v_age", "vw_map": "bi_map", "vw_ranking": "bi_ranking", "vw_gender": "bi_gender",
    "vw_age_focus": "bi_age", "vw_kpis_focus": "bi_kpis", "mart_entity_metrics": "entity_metrics",
}


def register_all_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose the star schema, the mart and every view to Spark SQL.
    Views are logical plans (ORDER BY inside a view is not a contract: order
    at the consumer)."""
    model.star_fact(spark, sf_dir).createOrReplaceTempView("fact_panel")
    model.dim_indicator(spark).createOrReplaceTempView("dim_indicator")
    model.entities(spark, sf_dir).createOrReplaceTempView("dim_entity")
    model.dim_level(spark).createOrReplaceTempView("dim_level")
    model.dim_sex(spark).createOrReplaceTempView("dim_sex")
    model.dim_age(spark).createOrReplaceTempView("dim_age")
    model.dim_category(spark).createOrReplaceTempView("dim_category")
    from .catalog import queries as all_queries   # every module registered
    qs = all_queries()
    for view, q in VIEW_NAMES.items():
        qs[q](spark, sf_dir).createOrReplaceTempView(view)
    return ["fact_panel", "dim_entity", "dim_level", "dim_sex", "dim_age", "dim_category", "dim_indicator", *VIEW_NAMES]


def load_warehouse(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Full-refresh load of the fact, the mart and the dimensions as one
    version of a ``Warehouse`` (doubles stored at 4 dp), plus CSV exports, one ordered file
    each, of the clean panel and of the per-entity metrics for BI tools.  The folders of the
    new version are returned; readers that must not miss a reload open the ``Warehouse``."""
    from .pipeline import clean_panel_q
    tables = {"fact_panel": model.star_fact(spark, sf_dir), "dim_indicator": model.dim_indicator(spark), "mart_entity_metrics": model.mart(spark, sf_dir),
              "dim_entity": model.entities(spark, sf_dir), "dim_level": model.dim_level(spark),
              "dim_sex": model.dim_sex(spark), "dim_age": model.dim_age(spark),
              "dim_category": model.dim_category(spark)}
    wh = Warehouse(spark, out_dir)
    wh.load(tables, {"fact_panel": ["is_aggregate"]})
    paths = {name: wh.folder(name) for name in tables}
    for name, df, order in (("export_clean_panel", clean_panel_q(spark, sf_dir, sort=False), ("entity", "category_code")),
                            ("export_entity_metrics", model.mart(spark, sf_dir), (F.col("gap_total").desc(),))):
        paths[name] = f"{wh.root}/{name}.csv"
        write_one_csv(df, paths[name], order)
    return paths
