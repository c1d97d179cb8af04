"""Range-clustered tables with a zone map.

The panel is written by ranges of its keys, sorted within each file, in place of one global
sort that every consumer would repeat.  A small table names the least and greatest key of
each file, so a query for one entity opens the few files that can hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """``df`` in about ``files`` files (by default a shuffle partition each), by ranges of ``keys``; the zone
    map is on the first of them and reads that column alone."""
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/data")
    written = df.sparkSession.read.parquet(f"{path}/data").select(F.col(keys[0]).alias("k"), F.col("_metadata.file_path").alias("file"))
    (written.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("k").isNull()).alias("nulls"),
                                 F.min("k").alias("low"), F.max("k").alias("high"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/zones"))


def read_clustered(spark: SparkSession, path: str, key: str, low=None, high=None) -> DataFrame:
    """Rows with ``low <= key <= high`` (either may be left out), from the files that can hold them."""
    whole, zones = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/zones")
    wanted = F.lit(True)
    if low is not None:
        zones, wanted = zones.where(F.col("high") >= F.lit(low)), wanted & (F.col(key) >= F.lit(low))
    if high is not None:
        zones, wanted = zones.where(F.col("low") <= F.lit(high)), wanted & (F.col(key) <= F.lit(high))
    files = [r["file"] for r in zones.select("file").collect()]  # names of files, as any scan lists them
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*files).where(wanted)
