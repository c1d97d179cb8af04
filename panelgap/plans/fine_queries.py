"""The quality rules on a fine panel, by supplier, where cells of under 50 and under 20 lines occur at
every size (P5, P14, P15, A9, C5, C12, C13, E5, E8, O6), and the clustered and exported tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NULL_CATEGORY
from ..ml.sample import label_rows
from ..operators.clean import clean_panel, profile_raw, raw_from_fact
from ..operators.expect import check_panel
from ..operators.metrics import cell_pivot
from ..session import ensure_checkpoint_dir
from ..sources.clustered import read_clustered, write_clustered
from ..sources.sinks import write_one_csv
from . import model
from . import oracle as O
from .pipeline import CODES, YEAR
from .queries import DEC_NULL, DEC_VAL, F_SEV, M_SEV, NO_VALUE, OK_TXT, PAIR_BAD_TXT
from .registry import query


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.fact(spark, sf_dir, entity="supplier")


def _names(fact: DataFrame) -> DataFrame:
    return fact.select("entity").distinct().withColumn("entity_name", F.concat(F.lit("Supplier "), "entity"))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _fact(spark, sf_dir)
    return raw_from_fact(fact, _names(fact), model.dim_level(spark), model.dim_sex(spark), model.dim_age(spark), YEAR)


def _sql(body: str) -> str:
    return O.with_fact(body, entity="supplier")


def fine_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that can't be relied on, those without a value first."""
    return (_fact(spark, sf_dir).where(~F.col("is_reliable"))
            .select("entity", "category_code", "n", F.coalesce(F.round("pct", 2).cast("string"), F.lit(NO_VALUE)).alias("value_text"),
                    F.coalesce("quality_flag", F.lit("-")).alias("flag"), F.when(F.col("pct").isNull(), DEC_NULL).otherwise(DEC_VAL).alias("decision"))
            .orderBy(F.col("value_text") == NO_VALUE, "entity", "category_code"))


query("fine_inventory", _sql(f"""
SELECT entity, category_code, n, IF(n < 20, '{NO_VALUE}', ROUND(100.0e0 * hits / n, 2)::VARCHAR) AS value_text, 'u' AS flag,
       IF(n < 20, '{DEC_NULL}', '{DEC_VAL}') AS decision
FROM cells WHERE n < 50"""))(fine_inventory)


def fine_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of the raw export, padded ones apart, null as its own group."""
    return profile_raw(_raw(spark, sf_dir))[1]


query("fine_flags", _sql("""
SELECT CASE WHEN n >= 50 THEN NULL WHEN ls = 'Total' THEN ' u ' ELSE 'u' END AS flag, COUNT(*) AS n FROM cells GROUP BY 1"""))(fine_flags)


def fine_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: padded flags are stripped, flagged cells and cells without a value are not reliable."""
    fact = _fact(spark, sf_dir)
    return clean_panel(_raw(spark, sf_dir), _names(fact), CODES, sort=False).select(
        "entity", "entity_name", "category_code", "level_label", "pct", "quality_flag", "is_reliable")


query("fine_clean", _sql("""
SELECT entity, 'Supplier ' || entity AS entity_name, category_code, level_label, IF(n < 20, NULL, 100.0e0 * hits / n) AS pct,
       IF(n < 50, 'u', NULL) AS quality_flag, n >= 50 AS is_reliable
FROM cells JOIN dim_level USING (level)"""))(fine_clean)


def fine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both statuses at the severe level, and whether both sides can be relied on."""
    piv = cell_pivot(_fact(spark, sf_dir), {"f": F_SEV, "m": M_SEV}, require=("f", "m"))
    return piv.select("entity", F.round("f", 2).alias("pct_female"), F.round("m", 2).alias("pct_male"), F.round(F.col("m") - F.col("f"), 2).alias("gender_gap_pp"),
                      F.when(F.col("f_rel") & F.col("m_rel"), OK_TXT).otherwise(PAIR_BAD_TXT).alias("quality"))


query("fine_pairs", _sql(f"""
, sides AS (SELECT entity, MAX(IF(n >= 20, pct, NULL)) FILTER (ls = 'F') AS f, MAX(IF(n >= 20, pct, NULL)) FILTER (ls = 'O') AS m, MIN(n) AS least
            FROM cells WHERE level = 'L_SEV' AND os = 'Total' AND ls IN ('F', 'O') GROUP BY entity HAVING COUNT(*) = 2)
SELECT entity, ROUND(f, 2) AS pct_female, ROUND(m, 2) AS pct_male, ROUND(m - f, 2) AS gender_gap_pp, IF(least >= 50, '{OK_TXT}', '{PAIR_BAD_TXT}') AS quality
FROM sides"""))(fine_pairs)


def fine_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reliable cells with their label, by level, beside all cells."""
    fact = _fact(spark, sf_dir)
    rows = label_rows(fact).groupBy("level").agg(F.count(F.lit(1)).alias("n_sample"), F.sum("label").alias("n_positive"))
    return fact.groupBy("level").agg(F.count(F.lit(1)).alias("n_cells")).join(rows, "level")


query("fine_sample", _sql("""
, limit_at AS (SELECT QUANTILE_CONT(pct, 0.5) AS t FROM fact WHERE NOT is_aggregate)
SELECT level, COUNT(*) AS n_cells, COUNT(*) FILTER (n >= 50) AS n_sample, COUNT(*) FILTER (n >= 50 AND pct < (SELECT t FROM limit_at))::BIGINT AS n_positive
FROM fact GROUP BY level"""))(fine_sample)


def fine_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing cells, values missing outside the category that may lack them, flags."""
    fact = _fact(spark, sf_dir)
    return check_panel(fact, _names(fact), model.dim_category(spark), n_categories=len(CODES), allowed_null_categories=[NULL_CATEGORY],
                       flag_domain=("x",)).where(F.col("check_name").isin("E1_row_count", "E5_null_categories", "E8_flag_domain", "E6_unique_key"))


query("fine_expectations", _sql(f"""
, found AS (SELECT 'E1_row_count' AS check_name, COUNT(DISTINCT entity) * 24 - COUNT(*) AS violations FROM cells
            UNION ALL SELECT 'E5_null_categories', COUNT(*) FROM cells WHERE n < 20 AND category_code <> '{NULL_CATEGORY}'
            UNION ALL SELECT 'E8_flag_domain', COUNT(*) FROM cells WHERE n < 50
            UNION ALL SELECT 'E6_unique_key', COUNT(*) - COUNT(DISTINCT (entity, category_code)) FROM cells)
SELECT check_name, violations::BIGINT AS violations, IF(violations = 0, 'pass', 'fail') AS status FROM found"""))(fine_expectations)


# ---- P11, S3, S4: clustered by entity, and one ordered file

def clustered_focus(spark: SparkSession, sf_dir: str, low: str = "S10", high: str = "S3") -> DataFrame:
    """A range of entities from the clustered panel, by way of its zone map."""
    path = f"{ensure_checkpoint_dir(spark)}/clustered-{uuid.uuid4().hex}"
    write_clustered(_fact(spark, sf_dir).select("entity", "category_code", "n", "pct"), path, ["entity", "category_code"])
    return read_clustered(spark, path, "entity", low, high)


query("clustered_focus", _sql("""
SELECT entity, category_code, n, pct FROM fact WHERE entity BETWEEN 'S10' AND 'S3'"""))(clustered_focus)


def export_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fine panel as one ordered CSV file, read back under its types."""
    path = f"{ensure_checkpoint_dir(spark)}/export-{uuid.uuid4().hex}.csv"
    write_one_csv(_fact(spark, sf_dir).select("entity", "category_code", "n", "pct", "quality_flag"), path, ["entity", "category_code"])
    return spark.read.schema("entity string, category_code string, n long, pct double, quality_flag string").option("header", True).csv(path)


query("export_readback", _sql("SELECT entity, category_code, n, pct, quality_flag FROM fact"))(export_readback)
