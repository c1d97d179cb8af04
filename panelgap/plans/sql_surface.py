"""The loaded warehouse as a SQL database (S9, S10): tables, views and the reports as text.

``open_database`` loads the star schema into a ``Warehouse``, declares its tables over the
committed folders and creates the views from their text, so any SQL client of the session
catalog can read them; nothing depends on a DataFrame of the session.  Reports are texts
with parameter markers, run with ``spark.sql(text, args)``.  ORDER BY stands at the
reports only.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_SPEC as S
from ..session import ensure_checkpoint_dir
from ..sources.warehouse import Warehouse
from . import model, reports, views  # noqa: F401  (their oracles are registered)
from . import queries as Q
from .registry import REGISTRY, query

#: Codes of the eight cells that the reports compare, by the name of their column in ``cells_wide``.
CELLS = {"ref": Q.REF, "ltd": "L_LTD", "sev": Q.SEV, "ltd_sev": "L_LTD_SEV", "fem": Q.F_SEV, "mal": Q.M_SEV, "mid": Q.MID_SEV, "old": Q.OLD_SEV}
_PIVOTED = ", ".join(f"'{code}' AS {name}" for name, code in CELLS.items())
_COLORS = " ".join(f"WHEN '{e}' THEN '{c}'" for e, c in S.highlight.items())

#: Views by name, in the order in which they build on each other; {db} is the database.
VIEWS = {
    # one row for each entity: value (x_v) and reliability (x_ok, null where the cell is absent) of every cell
    "cells_wide": f"""
SELECT entity_name, e.is_aggregate, p.*
FROM (SELECT * FROM (SELECT entity, category_code, pct, is_reliable FROM {{db}}.fact_panel)
      PIVOT (MAX(pct) AS v, BOOL_AND(is_reliable) AS ok FOR category_code IN ({_PIVOTED}))) p
JOIN {{db}}.dim_entity e ON e.entity = p.entity""",
    "v_full_dataset": """
SELECT entity, entity_name, e.is_aggregate, region, category_code, c.level, level_label, CAST(level_order AS BIGINT) AS level_order,
       c.ls, ls_label, c.os, os_label, is_core, has_known_data_issues, indicator, indicator_name, unit, reference_year,
       n, pct, pct_excluded, gap_vs_ref, pct_vs_bench, quality_flag, is_reliable
FROM {db}.fact_panel f JOIN {db}.dim_entity e USING (entity) JOIN {db}.dim_category c USING (category_code)
JOIN {db}.dim_indicator USING (indicator) JOIN {db}.dim_level l ON l.level = c.level
JOIN {db}.dim_sex s ON s.ls = c.ls JOIN {db}.dim_age a ON a.os = c.os""",
    "v_ranking_gap": """
SELECT entity, entity_name, is_aggregate, ROUND(ref_v, 2) AS pct_ref, ROUND(sev_v, 2) AS pct_sev,
       ROUND(ref_v - sev_v, 2) AS gap_total_pp, ROUND(100 - sev_v, 2) AS pct_excluded_sev,
       CAST(RANK() OVER (ORDER BY ref_v - sev_v DESC NULLS LAST) AS BIGINT) AS rank_by_gap
FROM {db}.cells_wide WHERE ref_ok IS NOT NULL AND sev_ok""",
    "v_gender_sev": """
SELECT entity, entity_name, ROUND(fem_v, 2) AS pct_female_sev, ROUND(mal_v, 2) AS pct_male_sev, ROUND(mal_v - fem_v, 2) AS gender_gap_pp
FROM {db}.cells_wide WHERE fem_ok IS NOT NULL AND mal_ok IS NOT NULL""",
    "v_age_sev": """
SELECT entity, entity_name, ROUND(mid_v, 2) AS pct_mid_sev, ROUND(old_v, 2) AS pct_old_sev, ROUND(mid_v - old_v, 2) AS age_effect_pp
FROM {db}.cells_wide WHERE mid_ok IS NOT NULL AND old_ok IS NOT NULL""",
    "mart_named": """
SELECT entity_name, iso2, region, m.* FROM {db}.mart_entity_metrics m JOIN {db}.dim_entity e ON e.entity = m.entity""",
    "vw_map": f"""
SELECT entity, entity_name, iso2, region, ROUND(pct_sev, 2) AS pct_sev, ROUND(gap_total, 2) AS gap_total_pp,
       ROUND(pct_excluded_sev, 2) AS pct_excluded, ROUND(gap_vs_bench, 2) AS vs_bench,
       COALESCE(inclusion_group, '{reports.BENCH_GROUP}') AS inclusion_group, rank_by_gap AS ranking_position
FROM {{db}}.mart_named""",
    "vw_ranking": f"""
SELECT entity_name, entity, ROUND(pct_ref, 2) AS pct_ref, ROUND(pct_sev, 2) AS pct_sev, ROUND(gap_total, 2) AS gap_pp,
       CASE entity {_COLORS} ELSE '{S.highlight_default}' END AS bar_color
FROM {{db}}.mart_named""",
    "vw_gender": f"""
SELECT entity_name, entity, ROUND(pct_female_sev, 2) AS pct_female, ROUND(pct_male_sev, 2) AS pct_male,
       ROUND(gap_gender, 2) AS gap_gender_pp, ROUND(100 - pct_female_sev, 2) AS pct_female_excluded,
       CAST(entity = '{S.focus_entity}' AS BIGINT) AS is_focus
FROM {{db}}.mart_named""",
    "vw_age_focus": f"""
SELECT os_label, CAST(os_order AS BIGINT) AS os_order, level_label, CAST(level_order AS BIGINT) AS level_order,
       ROUND(pct, 2) AS pct, ROUND(pct_excluded, 2) AS pct_excluded, is_reliable
FROM {{db}}.fact_panel JOIN {{db}}.dim_age USING (os) JOIN {{db}}.dim_level USING (level)
WHERE entity = '{S.focus_entity}' AND ls = 'Total' AND os <> 'Total' AND NOT level_is_aggregate""",
    "vw_kpis_focus": f"""
WITH w AS (SELECT entity, ref_v, sev_v, fem_v, old_v FROM {{db}}.cells_wide WHERE entity IN ('{S.focus_entity}', '{S.aggregate_entity}')),
long AS (SELECT entity, kpi_order, value
         FROM w LATERAL VIEW STACK(4, 1L, ROUND(ref_v - sev_v, 2), 2L, fem_v, 3L, old_v, 4L, ROUND(100 - sev_v, 2)) t AS kpi_order, value)
SELECT kpi_order, kpi, MAX(value) FILTER (WHERE entity = '{S.focus_entity}') AS focus_value,
       MAX(value) FILTER (WHERE entity = '{S.aggregate_entity}') AS bench_value, unit
FROM VALUES {', '.join(f"({o}L, '{name}', '{unit}')" for o, name, unit in reports.KPIS)} AS k(kpi_order, kpi, unit) JOIN long USING (kpi_order)
GROUP BY kpi_order, kpi, unit""",
}

#: The reports by name: text with markers, and their values.
REPORTS = {
    "p1_profile": ("""
SELECT CAST(level_order AS BIGINT) AS level_order, level_label, ROUND(pct, 2) AS pct, ROUND(pct_excluded, 2) AS pct_excluded,
       ROUND(gap_vs_ref, 2) AS gap_vs_ref_pp, IF(is_reliable, :good, :bad) AS quality
FROM {db}.fact_panel JOIN {db}.dim_level USING (level)
WHERE entity = :focus AND ls = 'Total' AND os = 'Total'
ORDER BY level_order""", {"focus": S.focus_entity, "good": Q.RELIABLE_TXT, "bad": Q.UNRELIABLE_TXT}),
    "p1_focus_vs_bench": ("""
WITH sides AS (SELECT level, MAX(pct) FILTER (WHERE entity = :focus) AS ours, MAX(pct) FILTER (WHERE entity = :bench) AS theirs
               FROM {db}.fact_panel WHERE entity IN (:focus, :bench) AND ls = 'Total' AND os = 'Total'
               GROUP BY level HAVING COUNT(DISTINCT entity) = 2)
SELECT level_label, ROUND(ours, 2) AS focus_pct, ROUND(theirs, 2) AS bench_pct, ROUND(ours - theirs, 2) AS diff_pp,
       CASE WHEN ours > theirs THEN :above WHEN ours < theirs THEN :below ELSE :equal END AS relative_position
FROM sides JOIN {db}.dim_level USING (level)
ORDER BY level_order""", {"focus": S.focus_entity, "bench": S.aggregate_entity, "above": Q.ABOVE, "below": Q.BELOW, "equal": Q.EQUAL}),
    "p1_ranking": ("""
WITH gaps AS (SELECT entity, entity_name, is_aggregate, ROUND(ref_v, 2) AS pct_ref, ROUND(sev_v, 2) AS pct_sev,
                     ROUND(ref_v - sev_v, 2) AS gap_pp, ROUND(100 - sev_v, 2) AS pct_excluded
              FROM {db}.cells_wide WHERE ref_ok IS NOT NULL AND sev_ok)
SELECT IF(is_aggregate, NULL, CAST(RANK() OVER (PARTITION BY is_aggregate ORDER BY gap_pp DESC NULLS LAST) AS BIGINT)) AS position,
       entity_name, pct_ref, pct_sev, gap_pp, ROUND(gap_pp - (SELECT MAX(gap_pp) FROM gaps WHERE entity = :bench), 2) AS vs_bench_pp,
       pct_excluded, CASE WHEN entity = :bench THEN :reference WHEN gap_pp < :low THEN :few WHEN gap_pp < :high THEN :some ELSE :many END AS inclusion_group
FROM gaps
ORDER BY is_aggregate, gap_pp DESC NULLS LAST, entity_name""",
                   {"bench": S.aggregate_entity, "reference": Q.REFERENCE_LABEL, "low": Q.RANK_BANDS[0], "high": Q.RANK_BANDS[1],
                    "few": Q.RANK_LABELS[0], "some": Q.RANK_LABELS[1], "many": Q.RANK_LABELS[2]}),
    "p1_pivot": ("""
SELECT entity_name, ROUND(ref_v, 2) AS pct_ref, ROUND(ltd_v, 2) AS pct_ltd, ROUND(sev_v, 2) AS pct_sev, ROUND(ref_v - sev_v, 2) AS gap_total
FROM {db}.cells_wide WHERE COALESCE(ref_ok, ltd_ok, sev_ok, ltd_sev_ok) IS NOT NULL
ORDER BY gap_total DESC NULLS LAST, entity_name""", {}),
    "p1_distance": ("""
WITH goal AS (SELECT STRUCT(MAX(ref_v) AS ref, MAX(sev_v) AS sev) AS focus FROM {db}.cells_wide WHERE entity = :focus)
SELECT entity_name, ROUND(ref_v, 2) AS pct_ref_leader, ROUND(sev_v, 2) AS pct_sev_leader,
       ROUND(sev_v - (SELECT focus.sev FROM goal), 2) AS improvement_needed_pp,
       ROUND((SELECT focus.ref - focus.sev FROM goal) - (ref_v - sev_v), 2) AS gap_reduction_needed_pp
FROM {db}.cells_wide WHERE ARRAY_CONTAINS(:leaders, entity) AND ref_ok IS NOT NULL AND sev_ok IS NOT NULL
ORDER BY sev_v DESC NULLS LAST""", {"focus": S.focus_entity, "leaders": list(S.leaders)}),
    "p2_gender_gap": ("""
SELECT entity_name, ROUND(fem_v, 2) AS pct_female, ROUND(mal_v, 2) AS pct_male, ROUND(mal_v - fem_v, 2) AS gender_gap_pp,
       ROUND(100 - fem_v, 2) AS pct_female_excluded,
       CASE WHEN mal_v - fem_v > :wide THEN :male WHEN fem_v - mal_v > :wide THEN :female ELSE :moderate END AS interpretation,
       IF(fem_ok AND mal_ok, :good, :bad) AS quality
FROM {db}.cells_wide WHERE fem_ok IS NOT NULL AND mal_ok IS NOT NULL
ORDER BY ABS(mal_v - fem_v) DESC NULLS LAST, entity_name""",
                      {"wide": Q.GENDER_BAND, "male": Q.G_MALE, "female": Q.G_FEMALE, "moderate": Q.G_MOD, "good": Q.OK_TXT, "bad": Q.PAIR_BAD_TXT}),
    "p2_focus_gender_by_level": ("""
WITH sides AS (SELECT level, MAX(pct) FILTER (WHERE ls = 'Total') AS t, MAX(pct) FILTER (WHERE ls = :female) AS f,
                      MAX(pct) FILTER (WHERE ls = :male) AS m
               FROM {db}.fact_panel WHERE entity = :focus AND os = 'Total' AND ls IN ('Total', :female, :male)
               GROUP BY level HAVING COUNT(DISTINCT ls) = 3)
SELECT level_label, ROUND(t, 2) AS pct_total, ROUND(f, 2) AS pct_female, ROUND(m, 2) AS pct_male, ROUND(m - f, 2) AS gender_gap_pp
FROM sides JOIN {db}.dim_level USING (level)
ORDER BY level_order""", {"focus": S.focus_entity, "female": S.female, "male": S.male}),
    "p3_age_effect": ("""
SELECT entity_name, ROUND(mid_v, 2) AS pct_mid_sev, ROUND(old_v, 2) AS pct_old_sev, ROUND(mid_v - old_v, 2) AS age_effect_pp,
       CASE WHEN mid_v - old_v > :b1 THEN :n1 WHEN mid_v - old_v > :b2 THEN :n2 WHEN mid_v - old_v > :b3 THEN :n3 ELSE :rest END AS classification,
       IF(mid_ok AND old_ok, :good, :bad) AS quality
FROM {db}.cells_wide WHERE mid_ok IS NOT NULL AND old_ok IS NOT NULL
ORDER BY age_effect_pp DESC NULLS LAST, entity_name""",
                      {"good": Q.OK_TXT, "bad": Q.PAIR_BAD_TXT, "rest": Q.AGE_ELSE}
                      | {f"b{i}": b for i, (b, _) in enumerate(Q.AGE_BANDS, 1)} | {f"n{i}": n for i, (_, n) in enumerate(Q.AGE_BANDS, 1)}),
    "p3_focus_age_by_level": ("""
SELECT os_label, level_label, ROUND(pct, 2) AS pct, ROUND(pct_excluded, 2) AS pct_excluded, ROUND(gap_vs_ref, 2) AS gap_vs_ref_pp,
       IF(is_reliable, :good, :bad) AS quality
FROM {db}.fact_panel JOIN {db}.dim_age USING (os) JOIN {db}.dim_level USING (level)
WHERE entity = :focus AND ls = 'Total' AND os <> 'Total' AND NOT level_is_aggregate
ORDER BY os_order, level_order""", {"focus": S.focus_entity, "good": Q.RELIABLE_TXT, "bad": Q.NO_DATA_TXT}),
    "topk_excluded": ("""
WITH least AS (SELECT entity, category_code, level, ls, os, pct, pct_excluded FROM {db}.fact_panel
               WHERE is_reliable AND pct IS NOT NULL ORDER BY pct, entity, category_code LIMIT :k)
SELECT entity_name, level, ls, os, ROUND(pct, 2) AS pct, ROUND(pct_excluded, 2) AS pct_excluded
FROM least JOIN {db}.dim_entity e USING (entity)
ORDER BY least.pct, entity, category_code""", {"k": 5}),
    "quality_inventory": ("""
SELECT entity_name, category_code, ls, os, level, COALESCE(CAST(ROUND(pct, 2) AS STRING), :none) AS value_text,
       COALESCE(quality_flag, '-') AS flag, IF(pct IS NULL, :drop, :keep) AS decision
FROM {db}.fact_panel JOIN {db}.dim_entity USING (entity) WHERE NOT is_reliable
ORDER BY pct IS NULL DESC, entity, category_code""", {"none": Q.NO_VALUE, "drop": Q.DEC_NULL, "keep": Q.DEC_VAL}),
    "stats_by_level": ("""
WITH one AS (SELECT level, COUNT(pct) AS n_obs, AVG(pct) AS mean, MIN(pct) AS low, MAX(pct) AS high,
                    COUNT_IF(NOT is_reliable) AS n_unreliable, COUNT_IF(pct IS NULL) AS n_null
             FROM {db}.fact_panel WHERE ls = 'Total' AND os = 'Total' GROUP BY level)
SELECT level_label, n_obs, ROUND(mean, 2) AS mean, ROUND(low, 2) AS minimum, ROUND(high, 2) AS maximum,
       ROUND(high - low, 2) AS value_range, n_unreliable, n_null
FROM one JOIN {db}.dim_level USING (level)
ORDER BY level_order""", {}),
    "quality_by_entity": ("""
WITH n AS (SELECT entity, COUNT(*) AS total_obs, COUNT_IF(is_reliable) AS reliable,
                  COUNT_IF(quality_flag = :flag AND pct IS NOT NULL) AS flagged_with_value, COUNT_IF(pct IS NULL) AS nulls
           FROM {db}.fact_panel GROUP BY entity)
SELECT entity_name, total_obs, reliable, flagged_with_value, nulls, ROUND(100.0D * reliable / total_obs, 1) AS pct_reliable
FROM n JOIN {db}.dim_entity USING (entity)
ORDER BY pct_reliable, entity_name""", {"flag": "u"}),
    "comparison_table": ("""
SELECT COALESCE(CAST(rank_by_gap AS STRING), '-') AS position, entity_name, ROUND(pct_ref, 2) AS pct_ref, ROUND(pct_sev, 2) AS pct_sev,
       ROUND(gap_total, 2) AS gap_total_pp, ROUND(gap_gender, 2) AS gap_gender_pp, ROUND(gap_age, 2) AS gap_age_pp,
       ROUND(gap_vs_bench, 2) AS vs_bench_pp, ROUND(pct_excluded_sev, 2) AS pct_excluded_sev, COALESCE(inclusion_group, :reference) AS inclusion_group
FROM {db}.mart_named
ORDER BY is_aggregate, gap_total DESC NULLS LAST, entity_name""", {"reference": reports.REF_TXT}),
}


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight tables of the star schema and its mart."""
    return {"fact_panel": model.star_fact(spark, sf_dir), "mart_entity_metrics": model.mart(spark, sf_dir),
            "dim_entity": model.entities(spark, sf_dir), "dim_level": model.dim_level(spark), "dim_sex": model.dim_sex(spark),
            "dim_age": model.dim_age(spark), "dim_category": model.dim_category(spark), "dim_indicator": model.dim_indicator(spark)}


def create_database(spark: SparkSession, wh: Warehouse, db: str, version: int | None = None) -> None:
    """Declares the tables of one version of a warehouse and all views in a database of the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, about in wh.manifest(version).items():
        if about["partition_by"]:
            raise ValueError(f"{name}: a partitioned table is read through Warehouse.read")
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        spark.sql(f"CREATE TABLE {db}.{name} USING parquet LOCATION '{wh.root}/{about['parts'][0]}'")
    for name, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {text.format(db=db)}")


def open_database(spark: SparkSession, sf_dir: str) -> str:
    """The database of a source folder, loaded on first use."""
    key = model._key(spark, sf_dir, "database")
    if key not in model._CACHE:
        wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")
        wh.load(star_tables(spark, sf_dir), digits=None)
        db = f"panel_{zlib.crc32(repr((key, wh.root)).encode()):08x}"
        create_database(spark, wh, db)
        model._CACHE[key] = db
    return model._CACHE[key]


def run_report(spark: SparkSession, db: str, name: str, **changed) -> DataFrame:
    """A report with its values, of which any may be changed."""
    text, args = REPORTS[name]
    unknown = set(changed) - set(args)
    if unknown:
        raise TypeError(f"{name} has no parameters {sorted(unknown)}")
    return spark.sql(text.format(db=db), args=args | changed)


def _register() -> None:
    for name in REPORTS:
        query(f"sql_{name}", REGISTRY[name].oracle)(
            lambda spark, sf_dir, n=name: run_report(spark, open_database(spark, sf_dir), n))
    for view, name in views.VIEW_NAMES.items():
        if view in VIEWS:
            query(f"sql_{view}", REGISTRY[name].oracle)(
                lambda spark, sf_dir, v=view: spark.table(f"{open_database(spark, sf_dir)}.{v}"))


_register()
