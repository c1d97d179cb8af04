"""Cleaning and expectations on a raw export with defects, by way of CSV.

The export repeats some rows under a foreign entity, under a code outside the list or
as they are, and has malformed (``:``) and impossible (101.5) values.  Which rows are
concerned follows from the number of observations behind a cell.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NULL_CATEGORY
from ..operators.clean import clean_panel
from ..operators.expect import check_panel
from ..session import ensure_checkpoint_dir
from ..sources.csv import read_raw_csv
from ..sources.sinks import write_csv
from . import model
from . import oracle as O
from .pipeline import CODES, raw_panel
from .registry import query

MALFORMED, IMPOSSIBLE, FOREIGN, UNLISTED, TWICE = 7, 11, 13, 17, 19
COLUMNS = ["entity", "category_code", "pct", "quality_flag", "is_reliable"]


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw panel with defects, written as CSV to the shared folder and read back as strings."""
    size = model.fact(spark, sf_dir).select(F.col("entity").alias("geo"), F.col("category_code").alias("ind_type"), "n")
    raw = raw_panel(spark, sf_dir).join(size, ["geo", "ind_type"])
    n = F.col("n")
    value = F.when(n % MALFORMED == 0, ":").when(n % IMPOSSIBLE == 0, "101.5").otherwise(F.col("OBS_VALUE"))
    raw = raw.withColumn("OBS_VALUE", value)
    out = (raw.unionByName(raw.where(n % FOREIGN == 0).withColumn("geo", F.concat(F.lit("XX_"), "geo")))
           .unionByName(raw.where(n % UNLISTED == 0).withColumn("ind_type", F.concat(F.lit("Y65_99_"), "ind_type")))
           .unionByName(raw.where(n % TWICE == 0)).drop("n"))
    path = f"{ensure_checkpoint_dir(spark)}/raw-export-{uuid.uuid4().hex}"
    write_csv(out, path)
    return read_raw_csv(spark, path)


def clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_panel(dirty_raw(spark, sf_dir), model.entities(spark, sf_dir), CODES, sort=False).select(*COLUMNS)


_DIRTY = f"""
, export AS (
  SELECT entity, category_code, n, quality_flag AS flag,
         CASE WHEN n % {MALFORMED} = 0 THEN ':' WHEN n % {IMPOSSIBLE} = 0 THEN '101.5' ELSE CAST(pct AS VARCHAR) END AS txt
  FROM fact),
lines AS (
  FROM export UNION ALL SELECT 'XX_' || entity, category_code, n, flag, txt FROM export WHERE n % {FOREIGN} = 0
  UNION ALL SELECT entity, 'Y65_99_' || category_code, n, flag, txt FROM export WHERE n % {UNLISTED} = 0
  UNION ALL FROM export WHERE n % {TWICE} = 0),
tidy AS (
  SELECT entity, category_code, TRY_CAST(txt AS DOUBLE) AS pct, flag AS quality_flag,
         flag IS NULL AND TRY_CAST(txt AS DOUBLE) IS NOT NULL AS is_reliable
  FROM lines SEMI JOIN dim_entity USING (entity) SEMI JOIN dim_category USING (category_code))"""

query("clean_dirty", O.with_fact(_DIRTY + "\nFROM tidy"))(clean_dirty)


def expectations_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on the cleaned export, and its keys before the filters (so that the
    foreign keys have something to find)."""
    raw = dirty_raw(spark, sf_dir).checkpoint()
    clean = clean_panel(raw, model.entities(spark, sf_dir), CODES, sort=False).checkpoint()
    entity_dim, category_dim = model.entities(spark, sf_dir), model.dim_category(spark)
    checks = check_panel(clean, entity_dim, category_dim, n_categories=len(CODES), allowed_null_categories=[NULL_CATEGORY])
    keys = raw.select(F.col("geo").alias("entity"), F.col("ind_type").alias("category_code"))
    loose = keys.withColumns({"pct": F.lit(0.0), "quality_flag": F.lit(None).cast("string"), "is_reliable": F.lit(True)})
    raw_checks = (check_panel(loose, entity_dim, category_dim, n_categories=len(CODES), allowed_null_categories=[])
                  .where(F.col("check_name").startswith("E7_"))
                  .withColumn("check_name", F.concat(F.lit("raw_"), "check_name")))
    return checks.where(~F.col("check_name").isin("E3_reliable_is_boolean", "E10_required_columns")).unionByName(raw_checks)


query("expectations_dirty", O.with_fact(_DIRTY + f""",
found AS (
  SELECT 'E1_row_count' AS check_name, ABS(COUNT(*) - (SELECT COUNT(*) FROM dim_entity) * {len(CODES)}) AS violations FROM tidy
  UNION ALL SELECT 'E2_entity_count', ABS(COUNT(DISTINCT entity) - (SELECT COUNT(*) FROM dim_entity)) FROM tidy
  UNION ALL SELECT 'E4_value_range', COUNT(*) FILTER (pct < 0 OR pct > 100) FROM tidy
  UNION ALL SELECT 'E5_null_categories', COUNT(*) FILTER (pct IS NULL AND category_code <> '{NULL_CATEGORY}') FROM tidy
  UNION ALL SELECT 'E6_unique_key', COUNT(*) - COUNT(DISTINCT (entity, category_code)) FROM tidy
  UNION ALL SELECT 'E8_not_null_keys', COUNT(*) - COUNT(entity || category_code) FROM tidy
  UNION ALL SELECT 'E8_flag_domain', COUNT(*) FILTER (quality_flag <> 'u') FROM tidy
  UNION ALL SELECT 'E7_fk_entity', 0 UNION ALL SELECT 'E7_fk_category', 0
  UNION ALL SELECT 'raw_E7_fk_entity', COUNT(*) FROM lines ANTI JOIN dim_entity USING (entity)
  UNION ALL SELECT 'raw_E7_fk_category', COUNT(*) FROM lines ANTI JOIN dim_category USING (category_code))
SELECT check_name, violations::BIGINT AS violations, IF(violations = 0, 'pass', 'fail') AS status FROM found"""))(expectations_dirty)


def missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1's list: the cells that every entity should have and for which the cleaned export has no value."""
    want = model.entities(spark, sf_dir).select("entity", F.explode(F.array(*[F.lit(c) for c in CODES])).alias("category_code"))
    return want.join(clean_dirty(spark, sf_dir).where("pct is not null").select("entity", "category_code"), ["entity", "category_code"], "left_anti")


query("missing_cells", O.with_fact(_DIRTY + """
SELECT entity, category_code FROM dim_entity CROSS JOIN (SELECT category_code FROM dim_category)
ANTI JOIN (FROM tidy WHERE pct IS NOT NULL) USING (entity, category_code)"""))(missing_cells)


def mart_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart by its gap, where a missing gap counts as zero."""
    return (model.mart(spark, sf_dir).select("entity", "gap_total", F.coalesce("gap_total", F.lit(0.0)).alias("sort_gap"))
            .orderBy(F.col("sort_gap").desc(), "entity"))


query("mart_readback", O.with_mart("SELECT entity, gap_total, IFNULL(gap_total, 0) AS sort_gap FROM mart"))(mart_readback)
