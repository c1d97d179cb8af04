"""The star schema's declared constraints, on the loaded tables and on copies with planted faults.

The faults follow from the values (lengths, counts, orders), so SQL can plant the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import TableRules, constraint_report
from . import model
from . import oracle as O
from .registry import query
from .sql_surface import star_tables

_PCT = ("pct_ref", "pct_sev", "pct_ltd", "pct_ltd_sev", "pct_female_sev", "pct_male_sev", "pct_mid_sev", "pct_old_sev")


_RANGES = [f"{c} BETWEEN 0 AND 100" for c in _PCT]

#: Constraints by table; the order of the levels is 1 to 4.
STAR_RULES = {
    "dim_entity": TableRules(["entity"], not_null=["entity_name", "is_aggregate", "region"]),
    "dim_level": TableRules(["level"], unique=[["level_order"]], not_null=["level_label", "level_is_aggregate"],
                            domains=["level_order BETWEEN 1 AND 4"]),
    "dim_sex": TableRules(["ls"], unique=[["ls_order"]], not_null=["ls_label"]),
    "dim_age": TableRules(["os"], unique=[["os_order"]], not_null=["os_label", "has_data_issues"],
                          domains=["age_min <= age_max"]),
    "dim_category": TableRules(["category_code"], unique=[["level", "ls", "os"]], not_null=["is_core", "has_known_data_issues"],
                               references={"level": ("dim_level", "level"), "ls": ("dim_sex", "ls"), "os": ("dim_age", "os")}),
    "dim_indicator": TableRules(["indicator"], not_null=["indicator_name", "unit", "reference_year"]),
    "fact_panel": TableRules(unique=[["indicator", "entity", "category_code"]],
                             not_null=["indicator", "entity", "category_code", "is_reliable"],
                             domains=["pct BETWEEN 0 AND 100", "quality_flag = 'u'", "n > 0"],
                             references={"indicator": ("dim_indicator", "indicator"), "entity": ("dim_entity", "entity"),
                                         "category_code": ("dim_category", "category_code")}),
    "mart_entity_metrics": TableRules(["entity"], not_null=["is_aggregate"],
                                      domains=[*_RANGES, "rank_by_gap >= 1"],
                                      references={"entity": ("dim_entity", "entity")}),
}


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraint_report(star_tables(spark, sf_dir), STAR_RULES)


def planted(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema with faults of every kind, and fact rows again by supplier, where cells are thin."""
    t = star_tables(spark, sf_dir)
    fact = t["fact_panel"]
    t["fact_panel"] = (
        fact.unionByName(fact.where("n % 7 = 0"))  # the same key twice
        .withColumn("pct", F.when(F.col("n") % 5 == 0, F.col("pct") + 100).otherwise(F.col("pct")))
        .withColumn("quality_flag", F.when(F.col("n") % 11 == 0, "x").otherwise(F.col("quality_flag")))
        .withColumn("entity", F.when(F.col("n") % 13 == 0, F.concat(F.lit("XX_"), "entity")).otherwise(F.col("entity")))
        .withColumn("is_reliable", F.when(F.col("n") % 17 != 0, F.col("is_reliable")))
        .withColumn("n", F.when(F.col("n") % 19 == 0, 0).otherwise(F.col("n"))))
    t["mart_entity_metrics"] = t["mart_entity_metrics"].withColumn("pct_sev", -F.col("pct_sev")).withColumn(
        "entity", F.when(F.col("rank_by_gap") > 5, F.col("entity")))
    t["dim_level"] = t["dim_level"].withColumn("level_order", F.when(F.col("level_is_aggregate"), 9).otherwise(1))
    t["dim_sex"] = t["dim_sex"].where("ls <> 'F'")
    t["dim_age"] = t["dim_age"].unionByName(t["dim_age"].where("os = 'O'")).withColumn("age_min", F.lit(9)).withColumn("age_max", F.lit(2))
    t["dim_entity"] = t["dim_entity"].withColumn("region", F.when(~F.col("is_aggregate"), F.col("region"))).where("entity <> 'NATION_3'")
    return t


def constraints_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraint_report(planted(spark, sf_dir), STAR_RULES)


# ---- the same in SQL, from the declarations of the tables written out once more

_SQL_RULES = {
    "dim_entity": ("entity", [], ["entity_name", "is_aggregate", "region"], [], {}),
    "dim_level": ("level", ["level_order"], ["level_label", "level_is_aggregate"], ["level_order BETWEEN 1 AND 4"], {}),
    "dim_sex": ("ls", ["ls_order"], ["ls_label"], [], {}),
    "dim_age": ("os", ["os_order"], ["os_label", "has_data_issues"], ["age_min <= age_max"], {}),
    "dim_category": ("category_code", ["level,ls,os"], ["is_core", "has_known_data_issues"], [],
                     {"level": "dim_level", "ls": "dim_sex", "os": "dim_age"}),
    "dim_indicator": ("indicator", [], ["indicator_name", "unit", "reference_year"], [], {}),
    "fact_panel": (None, ["indicator,entity,category_code"], ["indicator", "entity", "category_code", "is_reliable"],
                   ["pct BETWEEN 0 AND 100", "quality_flag = 'u'", "n > 0"],
                   {"indicator": "dim_indicator", "entity": "dim_entity", "category_code": "dim_category"}),
    "mart_entity_metrics": ("entity", [], ["is_aggregate"],
                            [*_RANGES, "rank_by_gap >= 1"],
                            {"entity": "dim_entity"}),
}


def _report_sql(name_of) -> str:
    """Every rule as a count over the table that ``name_of`` gives."""
    parts = []
    for t, (pk, unique, filled, domains, parents) in _SQL_RULES.items():
        def add(rule, label, count, t=t):
            quoted = label.replace("'", "''")
            parts.append(f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{quoted}' AS columns, ({count})::BIGINT AS violations")

        for c in ([pk] if pk else []) + filled:
            add("not_null", c, f"SELECT COUNT(*) - COUNT({c}) FROM {name_of(t)}")
        for good in domains:
            add("domain", good, f"SELECT COUNT(*) FILTER (NOT ({good})) FROM {name_of(t)}")
        for kind, key in ([("primary_key", pk)] if pk else []) + [("unique", u) for u in unique]:
            present = " AND ".join(f"{c} IS NOT NULL" for c in key.split(","))
            add(kind, key, f"SELECT COUNT(*) - COUNT(DISTINCT ({key})) FROM {name_of(t)} WHERE {present}")
        for c, parent in parents.items():
            pk_of = _SQL_RULES[parent][0]
            add("reference", f"{c}->{parent}.{pk_of}",
                f"SELECT COUNT(*) FROM {name_of(t)} x WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk_of} FROM {name_of(parent)} WHERE {pk_of} IS NOT NULL)")
    return ("SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n" + "\nUNION ALL ".join(parts) + ")")


_LOADED = O.with_mart("""
, fact_panel AS (SELECT *, (SELECT indicator FROM dim_indicator) AS indicator FROM fact),
mart_entity_metrics AS (SELECT * FROM mart),
dim_age_full AS (SELECT *, NULL::INT AS age_min, NULL::INT AS age_max, os = 'F' AS has_data_issues FROM dim_age)""")

query("constraints", _LOADED + "\n" + _report_sql(lambda t: "dim_age_full" if t == "dim_age" else t))(constraints)

query("constraints_planted", _LOADED + """,
bad_fact_panel AS (
  SELECT indicator, CASE WHEN n % 13 = 0 THEN 'XX_' || entity ELSE entity END AS entity, category_code,
         CASE WHEN n % 5 = 0 THEN pct + 100 ELSE pct END AS pct, CASE WHEN n % 11 = 0 THEN 'x' ELSE quality_flag END AS quality_flag,
         CASE WHEN n % 17 <> 0 THEN is_reliable END AS is_reliable, CASE WHEN n % 19 = 0 THEN 0 ELSE n END AS n
  FROM (FROM fact_panel UNION ALL FROM fact_panel WHERE n % 7 = 0)),
bad_mart_entity_metrics AS (SELECT * REPLACE (-pct_sev AS pct_sev, CASE WHEN rank_by_gap > 5 THEN entity END AS entity) FROM mart_entity_metrics),
bad_dim_level AS (SELECT * REPLACE (CASE WHEN level_is_aggregate THEN 9 ELSE 1 END AS level_order) FROM dim_level),
bad_dim_sex AS (FROM dim_sex WHERE ls <> 'F'),
bad_dim_age AS (SELECT * REPLACE (9 AS age_min, 2 AS age_max) FROM (FROM dim_age_full UNION ALL FROM dim_age_full WHERE os = 'O')),
bad_dim_entity AS (SELECT * REPLACE (CASE WHEN NOT is_aggregate THEN region END AS region) FROM dim_entity WHERE entity <> 'NATION_3')
""" + _report_sql(lambda t: t if t in ("dim_category", "dim_indicator") else f"bad_{t}"))(constraints_planted)
