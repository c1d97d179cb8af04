"""Sinks (S3, S4, S6, S7): full-refresh writes.

Loads go through ``warehouse``, whose tables appear whole or not at all.
``write_table`` is for scratch results: it deletes what was there before it writes.
Values are rounded to 4 dp on the way out as the reference stores them, and NaN never
exists (SQL NULL only).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), digits: int | None = 4,
                fmt: str = "parquet") -> None:
    """Full refresh of a table (optionally partitioned, e.g. by entity
    group for pruning)."""
    out = round_doubles(df, digits) if digits is not None else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


_AS_IS = {"encoding": "UTF-8", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, order_by: Sequence = ()) -> None:
    """CSV export with a header, UTF-8, no index column; the optional
    order is applied before writing (part files keep the range order).  White space
    around a value is part of it and stays."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").options(header=True, **_AS_IS).csv(path)


def write_one_csv(df: DataFrame, path: str, order_by: Sequence = ()) -> None:
    """One CSV file with one header line, in order, as a BI import wants it.

    Spark writes range-sorted parts without header; the file system then appends them in order, as
    streams of bytes, to a file that is renamed into place at the end.  No row becomes an
    object of the driver; the size of the file is the reader's concern."""
    spark, draft = df.sparkSession, f"{path}.parts-{uuid.uuid4().hex}"
    out = df.orderBy(*order_by) if order_by else df
    out.write.options(header=False, **_AS_IS).csv(f"{draft}/rows")
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(df.columns))])
    spark.createDataFrame([tuple(df.columns)], names).coalesce(1).write.option("header", False).csv(f"{draft}/header")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(conf)
    whole = fs.create(fs_path(f"{draft}/whole"), True)
    try:
        for part in ("header", "rows"):
            found = sorted(f.getPath().toString() for f in fs.listStatus(fs_path(f"{draft}/{part}")) if f.getPath().getName().startswith("part-"))
            for name in found:
                piece = fs.open(fs_path(name))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, whole, conf, False)
                finally:
                    piece.close()
    finally:
        whole.close()
    fs.delete(fs_path(path), True)
    fs.rename(fs_path(f"{draft}/whole"), fs_path(path))
    fs.delete(fs_path(draft), True)
