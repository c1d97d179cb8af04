"""What a load reports about itself: metrics of the write, rejected rows, refreshes read back, distinct profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_panel, load_and_clean
from ..operators.observed import clean_and_measure
from ..operators.sketch import approximate_distinct, exact_distinct, relative_bound, sketch_cube, sketch_groups
from ..session import ensure_checkpoint_dir
from ..sources.csv import read_typed_csv
from ..sources.quarantine import LINE, read_raw_lines, split, with_faults
from ..sources.sinks import write_csv
from ..sources.tables import panel_microdata
from ..sources.warehouse import Warehouse
from . import model
from . import oracle as O
from .dirty import _DIRTY, dirty_raw
from .pipeline import CODES, raw_panel
from .registry import query

BROKEN = 23


def _folder(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


# ---- S6, S7: a full load, a load that dies, a refresh of one partition, read back

FACT_COLS = ["entity", "is_aggregate", "category_code", "n", "pct", "quality_flag", "is_reliable", "gap_vs_ref"]


def refresh_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after four loads: a first one with wrong values, a full refresh, one that fails midway,
    and a refresh of the aggregate entity's partition alone, from wrong to right."""
    wh, fact = Warehouse(spark, _folder(spark, "refresh")), model.fact(spark, sf_dir).select(*FACT_COLS)
    parts = {"fact": ["is_aggregate"]}
    wrong = fact.withColumn("pct", F.lit(-1.0))
    wh.load({"fact": wrong, "mart": model.mart(spark, sf_dir)}, parts, digits=None)
    wh.load({"fact": fact.where(~F.col("is_aggregate")).unionByName(wrong.where("is_aggregate"))}, parts, digits=None)
    doomed = fact.withColumn("pct", F.when(F.col("n") > 0, F.raise_error(F.lit("load stopped"))).cast("double"))
    try:
        wh.load({"mart": model.mart(spark, sf_dir).limit(0), "fact": doomed}, parts, digits=None)
    except Exception as e:
        if "load stopped" not in str(e):
            raise
    wh.load({"fact": fact.where("is_aggregate")}, digits=None, only_partitions=True)
    kept = wh.read("mart").agg(F.count(F.lit(1))).scalar()
    return wh.read("fact").select(*FACT_COLS).withColumn("mart_rows", kept)


query("refresh_readback", O.with_mart(f"""
SELECT {', '.join(FACT_COLS)}, (SELECT COUNT(*) FROM mart) AS mart_rows FROM fact"""))(refresh_readback)


# ---- P8, A9, A10, A12: metrics of the write

def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that the job writing the clean panel (of the export with defects) counted on its way."""
    got = clean_and_measure(dirty_raw(spark, sf_dir), model.entities(spark, sf_dir), CODES, _folder(spark, "clean"))
    return spark.createDataFrame([got], ", ".join(f"{k} {'double' if k.endswith('_value') else 'long'}" for k in got))


query("load_metrics", O.with_fact(_DIRTY + """,
flagged AS (SELECT txt, CASE WHEN flag IS NOT NULL THEN IF(ls = 'Total', ' u ', 'u') END AS flag
            FROM lines JOIN (SELECT entity AS e, category_code AS c, ls FROM fact) ON ends_with(lines.entity, e) AND length(lines.entity) - length(e) IN (0, 3)
                 AND ends_with(lines.category_code, c) AND length(lines.category_code) - length(c) IN (0, 7))
SELECT * FROM (SELECT COUNT(*) AS n_raw, COUNT(*) - COUNT(TRY_CAST(txt AS DOUBLE)) AS n_unparsed, COUNT(*) - COUNT(flag) AS flag_none,
                      COUNT(*) FILTER (flag = 'u') AS flag_0, COUNT(*) FILTER (flag = ' u ') AS flag_1, 0 AS flag_other FROM flagged),
  (SELECT COUNT(*) AS n_clean, COUNT(*) FILTER (is_reliable) AS n_reliable, COUNT(*) FILTER (pct NOT BETWEEN 0 AND 100) AS n_out_of_range,
          MIN(pct) AS min_value, MAX(pct) AS max_value FROM tidy)"""))(load_metrics)


# ---- S1, P2, P3, P7: rejected lines and values

def broken_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export with defects, and some of its lines once more, cut off after five fields."""
    path, size = _folder(spark, "broken-export"), model.fact(spark, sf_dir).select(F.col("entity").alias("geo"), F.col("category_code").alias("ind_type"), "n")
    raw = dirty_raw(spark, sf_dir)
    write_csv(raw, path)
    cut = raw_panel(spark, sf_dir).join(size, ["geo", "ind_type"]).where(F.col("n") % BROKEN == 0)
    cut.select("geo", "ind_type", "TIME_PERIOD", "OBS_VALUE").write.mode("append").option("header", True).csv(path)
    return read_raw_lines(spark, path, raw.columns)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of faults by column, reason and whether the row had to go; broken lines by their first field."""
    checked = with_faults(broken_export(spark, sf_dir), model.entities(spark, sf_dir), CODES)
    _, faults = split(checked, _folder(spark, "quarantine"))
    line = F.col("column") == LINE
    return (faults.groupBy(F.when(line, F.lit("line")).otherwise(F.col("column")).alias("column_name"), "reason", "rejected",
                           F.when(line, F.split("value", ",")[0]).otherwise(F.col("value")).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


query("rejects", O.with_fact(_DIRTY + f""",
judged AS (SELECT *, entity NOT IN (SELECT entity FROM dim_entity) AS foreign_one,
                  category_code NOT IN (SELECT category_code FROM dim_category) AS unlisted FROM lines),
faults AS (
  SELECT 'OBS_VALUE' AS column_name, 'not a number' AS reason, foreign_one OR unlisted AS rejected, txt AS value FROM judged
  WHERE txt IS NOT NULL AND TRY_CAST(txt AS DOUBLE) IS NULL
  UNION ALL SELECT 'OBS_VALUE', 'out of range', foreign_one OR unlisted, txt FROM judged WHERE TRY_CAST(txt AS DOUBLE) NOT BETWEEN 0 AND 100
  UNION ALL SELECT 'geo', 'unknown entity', true, entity FROM judged WHERE foreign_one
  UNION ALL SELECT 'ind_type', 'unlisted category', true, category_code FROM judged WHERE unlisted
  UNION ALL SELECT 'line', 'broken line', true, entity FROM fact WHERE n % {BROKEN} = 0)
SELECT column_name, reason, rejected, value, COUNT(*) AS n FROM faults GROUP BY ALL"""))(rejects)


def kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What quarantine leaves, cleaned: the same as cleaning the export without broken lines."""
    checked = with_faults(broken_export(spark, sf_dir), model.entities(spark, sf_dir), CODES)
    kept, _ = split(checked, _folder(spark, "quarantine"))
    return clean_panel(kept, model.entities(spark, sf_dir), CODES, sort=False).select("entity", "category_code", "pct", "quality_flag", "is_reliable")


query("kept_rows", O.with_fact(_DIRTY + "\nFROM tidy"))(kept_rows)


# ---- P6, P10, S2: the other preset, other labels, a typed export

OTHER_LABELS = {"L_NONE": "none", "L_LTD": "some", "L_SEV": "severe"}


def preset_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No filter, flags as they are (so a padded one stays reliable), labels of the caller."""
    names = model.entities(spark, sf_dir).select("entity", "entity_name")
    return load_and_clean(dirty_raw(spark, sf_dir), names, OTHER_LABELS).select(
        "entity", "entity_name", "category_code", "level_label", "ls", "os", "pct", "quality_flag", "is_reliable")


query("preset_clean", O.with_fact(_DIRTY + """,
parsed AS (SELECT *, regexp_extract(category_code, '^(G[FO]_)?(B[FOP]_)?(.*)$', ['g', 'b', 'rest']) AS p FROM lines),
labelled AS (SELECT parsed.*, f.ls AS own_ls FROM parsed LEFT JOIN fact f ON f.entity = replace(parsed.entity, 'XX_', '')
             AND f.category_code = replace(parsed.category_code, 'Y65_99_', ''))
SELECT l.entity, d.entity_name, category_code, CASE p.rest WHEN 'L_NONE' THEN 'none' WHEN 'L_LTD' THEN 'some' WHEN 'L_SEV' THEN 'severe' ELSE p.rest END AS level_label,
       CASE p.g WHEN '' THEN 'Total' ELSE p.g[2] END AS ls, CASE p.b WHEN '' THEN 'Total' ELSE p.b[2] END AS os,
       TRY_CAST(txt AS DOUBLE) AS pct, CASE WHEN flag IS NOT NULL THEN IF(own_ls = 'Total', ' u ', 'u') END AS quality_flag,
       NOT (flag IS NOT NULL AND own_ls <> 'Total') AND txt IS NOT NULL AS is_reliable
FROM labelled l LEFT JOIN dim_entity d ON d.entity = l.entity"""))(preset_clean)


def typed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean panel written as CSV and read back under its types; a value that doesn't parse is null."""
    path = _folder(spark, "typed-export")
    fact = model.fact(spark, sf_dir)
    write_csv(fact.select("entity", "category_code", "n", F.when(F.col("n") % 7 == 0, "?").otherwise(F.col("pct").cast("string")).alias("pct"), "is_reliable"), path)
    return read_typed_csv(spark, path, "entity string, category_code string, n long, pct double, is_reliable boolean")


query("typed_export", O.with_fact("""
SELECT entity, category_code, n, CASE WHEN n % 7 <> 0 THEN pct END AS pct, is_reliable FROM fact"""))(typed_export)


# ---- A8: distinct profile by sketches, audited

def distinct_profile(spark: SparkSession, sf_dir: str, value: str = "order_id") -> DataFrame:
    """For every cell the exact number of distinct orders, the bound of the sketch's error and whether the
    estimate keeps it."""
    micro = panel_microdata(spark, sf_dir, keys={"l_orderkey": value})
    approx = approximate_distinct(sketch_cube(sketch_groups(micro, value)))
    exact = exact_distinct(micro, value)
    return (exact.join(approx.select("entity", "category_code", "approx_n"), ["entity", "category_code"], "full")
            .select("entity", "category_code", "exact_n", F.round(F.col("exact_n") * relative_bound(), 4).alias("max_error"),
                    (F.abs(F.col("approx_n") - F.col("exact_n")) <= F.col("exact_n") * relative_bound()).alias("within")))


query("distinct_profile", f"""
WITH {O.cells_cte().replace("AS hit", "AS hit, l.l_orderkey AS order_id", 1).replace("ls, os, hit", "ls, os, hit, order_id").replace(
    "COUNT(*) AS n, SUM(hit) AS h", "COUNT(DISTINCT order_id) AS exact_n, COUNT(*) AS n, SUM(hit) AS h").replace(
    "100.0e0 * h / n AS pct", "100.0e0 * h / n AS pct, exact_n")}
SELECT entity, category_code, exact_n, ROUND(exact_n * {relative_bound()!r}::DOUBLE, 4) AS max_error, TRUE AS within FROM cells""")(distinct_profile)

