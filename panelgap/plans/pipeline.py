"""Cleaning pipeline, expectations and integrity checks as registered queries.

The raw long-format export is produced from the fact by Spark (all strings,
flag padding, unused columns) and cleaned back; the checks run on the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NULL_CATEGORY, all_category_codes
from ..operators.clean import CLEAN_COLUMNS, clean_panel, profile_raw, raw_from_fact
from ..operators.expect import check_panel, fk_violations
from ..sources.tables import read_table
from . import model
from . import oracle as O
from .registry import query

CODES = [c for c, *_ in all_category_codes()]
YEAR = "1998"


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the entity dimension comes from nation (25 rows by construction)
    return raw_from_fact(model.fact(spark, sf_dir), F.broadcast(model.entities(spark, sf_dir)), model.dim_level(spark),
                         model.dim_sex(spark), model.dim_age(spark), YEAR)


def clean_panel_q(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    return clean_panel(raw_panel(spark, sf_dir), F.broadcast(model.entities(spark, sf_dir)), CODES, sort=sort)


_CLEAN_SQL = f"""
, clean AS (
  SELECT CAST({YEAR} AS INTEGER) AS year, f.entity, c.entity_name, c.entity_name AS entity_label,
         f.category_code, dl.level_label, f.ls, f.os,
         CONCAT_WS(' - ', CASE WHEN f.ls <> 'Total' THEN s.ls_label END,
                   CASE WHEN f.os <> 'Total' THEN a.os_label END, dl.level_label) AS category_desc,
         f.pct, f.quality_flag, f.is_reliable
  FROM fact f JOIN dim_entity c ON f.entity = c.entity JOIN dim_level dl ON f.level = dl.level
  JOIN dim_sex s ON f.ls = s.ls JOIN dim_age a ON f.os = a.os)"""

query("clean_panel", O.with_fact(_CLEAN_SQL + "\nSELECT " + ", ".join(CLEAN_COLUMNS) +
                                 " FROM clean ORDER BY entity, level_label, ls, os"))(clean_panel_q)


def flag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flag histogram, NULL counted as its own group."""
    return profile_raw(raw_panel(spark, sf_dir))[1]


query("flag_histogram", O.with_fact("""
SELECT CASE WHEN quality_flag IS NULL THEN NULL WHEN ls = 'Total' THEN ' u ' ELSE 'u' END AS flag,
       COUNT(*) AS n
FROM fact GROUP BY 1"""))(flag_histogram)


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that do not parse as numbers, sorted distinct entities."""
    prof, _ = profile_raw(raw_panel(spark, sf_dir))
    return prof.select("n_unparsed", F.array_join("entities", ",").alias("entities"))


query("raw_profile", O.with_fact("""
SELECT COUNT(*) FILTER (WHERE pct IS NULL) AS n_unparsed,
       ARRAY_TO_STRING(LIST(DISTINCT entity ORDER BY entity), ',') AS entities
FROM fact"""))(raw_profile)


def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the cleaned panel is read by four check branches: materialise it once
    # (eagerly, so the branches do not race to compute it)
    clean = clean_panel_q(spark, sf_dir, sort=False).checkpoint(eager=True)
    return check_panel(clean, model.entities(spark, sf_dir), model.dim_category(spark),
                       n_categories=len(CODES), allowed_null_categories=[NULL_CATEGORY],
                       required=CLEAN_COLUMNS)


query("expectations", O.with_fact(_CLEAN_SQL + f""",
r AS (
  SELECT COUNT(*) AS n_rows, COUNT(DISTINCT entity) AS n_ent,
         COUNT(*) FILTER (WHERE pct IS NOT NULL AND NOT (pct BETWEEN 0 AND 100)) AS out_of_range,
         COUNT(*) FILTER (WHERE pct IS NULL AND category_code NOT IN ('{NULL_CATEGORY}')) AS bad_nulls,
         COUNT(*) FILTER (WHERE entity IS NULL OR category_code IS NULL) AS null_keys,
         COUNT(*) FILTER (WHERE quality_flag IS NOT NULL AND quality_flag NOT IN ('u')) AS bad_flags,
         (SELECT COUNT(*) FROM dim_entity) AS n_ent_expected
  FROM clean),
k AS (SELECT entity, category_code, COUNT(*) AS c FROM clean GROUP BY 1, 2),
checks AS (
  SELECT 'E1_row_count' AS check_name, CAST(ABS(n_rows - n_ent_expected * {len(CODES)}) AS BIGINT) AS violations FROM r
  UNION ALL SELECT 'E2_entity_count', CAST(ABS(n_ent - n_ent_expected) AS BIGINT) FROM r
  UNION ALL SELECT 'E4_value_range', CAST(out_of_range AS BIGINT) FROM r
  UNION ALL SELECT 'E5_null_categories', CAST(bad_nulls AS BIGINT) FROM r
  UNION ALL SELECT 'E8_not_null_keys', CAST(null_keys AS BIGINT) FROM r
  UNION ALL SELECT 'E8_flag_domain', CAST(bad_flags AS BIGINT) FROM r
  UNION ALL SELECT 'E6_unique_key', CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) FROM k
  UNION ALL SELECT 'E7_fk_entity', CAST(COUNT(*) AS BIGINT) FROM clean x
            WHERE NOT EXISTS (SELECT 1 FROM dim_entity d WHERE d.entity = x.entity)
  UNION ALL SELECT 'E7_fk_category', CAST(COUNT(*) AS BIGINT) FROM clean x
            WHERE NOT EXISTS (SELECT 1 FROM dim_category d WHERE d.category_code = x.category_code)
  UNION ALL SELECT 'E3_reliable_is_boolean', CAST(COUNT(DISTINCT typeof(is_reliable)) FILTER (typeof(is_reliable) <> 'BOOLEAN') AS BIGINT) FROM clean
  UNION ALL SELECT 'E10_required_columns', CAST({len(CLEAN_COLUMNS)} - COUNT(*) AS BIGINT)
            FROM (SELECT UNNEST(json_keys(to_json(one))) AS name FROM (FROM clean LIMIT 1) one)
            WHERE name IN ({', '.join(f"'{c}'" for c in CLEAN_COLUMNS)}))
SELECT check_name, violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM checks"""))(expectations)


FKS = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey"),
]


def fk_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns: dict[str, list[str]] = {}
    for _, c, ck, _, _ in FKS:
        columns.setdefault(c, []).append(ck)
    child = {c: read_table(spark, sf_dir, c, *cks) for c, cks in columns.items()}
    pairs = [(n, child[c], ck, read_table(spark, sf_dir, p, pk), pk) for n, c, ck, p, pk in FKS]
    fact = model.star_fact(spark, sf_dir)
    pairs += [("fact.indicator->dim_indicator", fact, "indicator", model.dim_indicator(spark), "indicator")]
    pairs += [("fact.entity->dim_entity", fact, "entity", model.entities(spark, sf_dir), "entity"),
              ("fact.category_code->dim_category", fact, "category_code", model.dim_category(spark),
               "category_code")]
    category = model.dim_category(spark)
    pairs += [(f"dim_category.{k}->dim", category, k, dim, k) for k, dim in (
        ("level", model.dim_level(spark)), ("ls", model.dim_sex(spark)), ("os", model.dim_age(spark)))]
    pairs += [("mart.entity->dim_entity", model.mart(spark, sf_dir), "entity", model.entities(spark, sf_dir), "entity")]
    return fk_violations(pairs)


def _fk_sql():
    parts = [f"SELECT '{n}' AS fk, CAST(COUNT(*) AS BIGINT) AS violations FROM {c} x "
             f"WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})"
             for n, c, ck, p, pk in FKS]
    parts.append("SELECT 'fact.entity->dim_entity', CAST(COUNT(*) AS BIGINT) FROM fact x "
                 "WHERE NOT EXISTS (SELECT 1 FROM dim_entity y WHERE y.entity = x.entity)")
    parts.append("SELECT 'fact.category_code->dim_category', CAST(COUNT(*) AS BIGINT) FROM fact x "
                 "WHERE NOT EXISTS (SELECT 1 FROM dim_category y WHERE y.category_code = x.category_code)")
    parts.append("SELECT 'fact.indicator->dim_indicator', COUNT(*) FROM (SELECT (SELECT MIN(indicator) FROM dim_indicator) AS indicator FROM fact) "
                 "ANTI JOIN dim_indicator USING (indicator)")
    parts += [f"SELECT 'dim_category.{k}->dim', COUNT(*) FROM dim_category ANTI JOIN {d} USING ({k})"
              for k, d in (("level", "dim_level"), ("ls", "dim_sex"), ("os", "dim_age"))]
    parts.append("SELECT 'mart.entity->dim_entity', COUNT(*) FROM mart ANTI JOIN dim_entity USING (entity)")
    return "\n" + "\nUNION ALL ".join(parts)


query("fk_violations", O.with_mart(_fk_sql()))(fk_violations_q)


def range_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside [0, 100] plus min and max of the cleaned panel."""
    from ..operators.clean import range_report
    return range_report(clean_panel_q(spark, sf_dir, sort=False))


query("range_report", O.with_fact("""
SELECT COUNT(*) FILTER (WHERE pct IS NOT NULL AND NOT (pct BETWEEN 0 AND 100)) AS n_out_of_range,
       MIN(pct) AS min_value, MAX(pct) AS max_value
FROM fact"""))(range_report_q)


def load_verify(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    """The loader's control queries in one row: table sizes, the
    focus entity's gap and the top-k entities by gap (aggregate excluded)."""
    from ..operators.rank import top_k
    fact, mart = model.fact(spark, sf_dir), model.mart(spark, sf_dir)
    top = top_k(mart.where(~F.col("is_aggregate") & F.col("gap_total").isNotNull()), k,
                [F.col("gap_total").desc(), F.col("entity").asc()])
    top_s = top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct((-F.col("gap_total")).alias("g"), F.col("entity").alias("e")))), lambda x: x["e"]), ",")
        .alias("top")).scalar()
    one = mart.agg(F.count(F.lit(1)).alias("mart_rows"),
                   F.max(F.when(F.col("entity") == model.DEFAULT_SPEC.focus_entity, F.col("gap_total")))
                   .alias("focus_gap"))
    return one.select(fact.agg(F.count(F.lit(1))).scalar().alias("fact_rows"), "mart_rows", "focus_gap",
                      top_s.alias("top_entities"))


query("load_verify", O.with_mart(f"""
SELECT (SELECT COUNT(*) FROM fact) AS fact_rows, (SELECT COUNT(*) FROM mart) AS mart_rows,
       (SELECT MAX(gap_total) FROM mart WHERE entity = 'NATION_3') AS focus_gap,
       (SELECT STRING_AGG(entity, ',' ORDER BY gap_total DESC, entity)
        FROM (SELECT entity, gap_total FROM mart WHERE NOT is_aggregate AND gap_total IS NOT NULL
              ORDER BY gap_total DESC, entity LIMIT 3)) AS top_entities"""))(load_verify)
