"""Incremental panel maintenance with Structured Streaming.

New line-item files are folded in as they arrive.  Each micro-batch appends its counts
by order key (a folder for each epoch, renamed into place when it is whole, and replaced if the batch
runs again), so the stream holds no state.  Orders join when the panel is read: line items whose order
arrives later are counted from then on.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.panel import expand_cube
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table, table_path


def _orders_with_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    ce = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select("c_custkey", F.col("n_name").alias("entity"))
    return orders.join(ce, orders.o_custkey == ce.c_custkey).select("o_orderkey", "o_orderstatus", "entity")


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, as Spark sees it, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def start_panel_stream(spark: SparkSession, sf_dir: str, out_dir: str, checkpoint: str,
                       lineitem_path: str | None = None, hit_threshold: float = 20.0,
                       files_per_trigger: int = 1, available_now: bool = True):
    """Start the stream; returns the StreamingQuery.  ``out_dir`` receives the
    counts by order of every micro-batch."""
    path = lineitem_path or table_path(sf_dir, "lineitem")
    schema = spark.read.parquet(path).select(
        "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    src = path
    file_system, where = _file_system(spark, path)
    if file_system.getFileStatus(where).isFile():
        # a single file: the file source lists a folder or a glob, so watch the
        # folder through a glob matching this file name (and later arrivals
        # named like it)
        d, name = os.path.split(path)
        src = os.path.join(d, f"[{name[0]}]{name[1:]}")
        reader = reader.option("basePath", d)
    li = (reader.parquet(src)
          .select("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus"))

    def append(batch: DataFrame, epoch: int) -> None:
        # readers skip names that begin with an underscore: an epoch appears when it is whole
        draft, target = f"{out_dir}/_draft-{uuid.uuid4().hex}", f"{out_dir}/epoch={epoch}"
        (batch.groupBy("l_orderkey", F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("l_quantity") > F.lit(hit_threshold)).cast("long")).alias("hits"))
         .write.parquet(draft))
        files, there = _file_system(batch.sparkSession, target)
        files.delete(there, True)  # of a run of this batch that was cut off after its rename
        files.rename(_file_system(batch.sparkSession, draft)[1], there)

    w = li.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def panel_groups(spark: SparkSession, sf_dir: str, out_dir: str) -> DataFrame:
    """Counts by (entity, rf, ls, os) of the line items folded in so far whose order is there."""
    oe = _orders_with_entity(spark, sf_dir)
    by_order = spark.read.parquet(out_dir).groupBy("l_orderkey", "rf", "ls").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return (by_order.join(oe, by_order.l_orderkey == oe.o_orderkey)
            .groupBy("entity", "rf", "ls", F.col("o_orderstatus").alias("os"))
            .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")))


def panel_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream over all available line-item files and return the cube.
    Offsets and output live under the session's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    run = os.path.join(root, f"panel-stream-{uuid.uuid4().hex}")
    out_dir, ckpt = os.path.join(run, "groups"), os.path.join(run, "state")
    q = start_panel_stream(spark, sf_dir, out_dir, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return expand_cube(panel_groups(spark, sf_dir, out_dir))
