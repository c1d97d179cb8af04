"""Rejected lines and values of a raw export.

Cleaning turns a value that doesn't parse into null and drops foreign rows without a word.
Here every row gets the list of what is wrong with it, in the same pass that types it;
rows whose line is broken, or whose keys are not wanted, go to quarantine, others are kept
with the faulty value null, and both are listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import null_na_tokens

BROKEN_LINE, NOT_A_NUMBER, NOT_A_YEAR, OUT_OF_RANGE = "broken line", "not a number", "not a year", "out of range"
UNKNOWN_ENTITY, UNLISTED_CATEGORY, UNKNOWN_FLAG = "unknown entity", "unlisted category", "unknown flag"
LINE = "_line"


def read_raw_lines(spark: SparkSession, path: str, columns: Sequence[str], keep_tokens=("geo", "ind_type")) -> DataFrame:
    """The export as strings under a known header, with ``_line``: the text of a line that doesn't have
    the header's number of fields, else null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, LINE]])
    df = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", LINE).csv(path))
    return null_na_tokens(df, keep=[*keep_tokens, LINE])


def _fault(column: str, value: Column, reason: str, bad: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)),
                  F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason")))


def with_faults(raw: DataFrame, entities: DataFrame, codes: Sequence[str], flags: Sequence[str] = ("u",),
                low: float = 0.0, high: float = 100.0) -> DataFrame:
    """``raw`` with ``faults``, a list of (column, value, reason), and ``rejected``: whether the row can't stay.

    Missing values are no faults.  ``entities`` are the wanted ones (column ``entity``); the join on them is
    the one that the cleaning makes anyway."""
    value, year, flag = F.col("OBS_VALUE"), F.col("TIME_PERIOD"), F.trim("OBS_FLAG")
    number = value.try_cast("double")
    broken = F.col(LINE).isNotNull()
    wanted = entities.select(F.col("entity").alias("_wanted")).distinct()
    checks = [
        _fault("OBS_VALUE", value, NOT_A_NUMBER, value.isNotNull() & number.isNull()),
        _fault("OBS_VALUE", value, OUT_OF_RANGE, ~number.between(low, high)),
        _fault("TIME_PERIOD", year, NOT_A_YEAR, year.isNotNull() & year.try_cast("int").isNull()),
        _fault("OBS_FLAG", F.col("OBS_FLAG"), UNKNOWN_FLAG, (flag != "") & ~flag.isin(*flags)),
        _fault("geo", F.col("geo"), UNKNOWN_ENTITY, F.col("_wanted").isNull()),
        _fault("ind_type", F.col("ind_type"), UNLISTED_CATEGORY, ~F.coalesce(F.col("ind_type").isin(*codes), F.lit(False))),
    ]
    found = F.when(broken, F.array(_fault(LINE, F.col(LINE), BROKEN_LINE, F.lit(True)))).otherwise(F.array_compact(F.array(*checks)))
    stays = ~broken & F.col("_wanted").isNotNull() & F.coalesce(F.col("ind_type").isin(*codes), F.lit(False))
    return (raw.join(wanted, F.col("geo") == F.col("_wanted"), "left").withColumn("faults", found)
            .withColumn("rejected", ~stays).drop("_wanted"))


def split(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, faults), from one pass over ``checked``: rows are written once under ``path``, by
    ``rejected``, and both results read what they need.  The faults of kept rows are listed too."""
    checked.write.mode("overwrite").partitionBy("rejected").parquet(path)
    written = checked.sparkSession.read.schema(checked.schema).parquet(path)
    kept = written.where(~F.col("rejected")).drop("faults", "rejected", LINE)
    faults = (written.where(F.size("faults") > 0)
              .select(F.col("geo").alias("entity"), F.col("ind_type").alias("category_code"), "rejected", F.explode("faults").alias("f"))
              .select("entity", "category_code", "rejected", "f.column", "f.value", "f.reason"))
    return kept, faults
