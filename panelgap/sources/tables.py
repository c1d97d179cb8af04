"""Parquet table sources and the microdata feed of the panel.

Every reader selects only the columns its caller needs so that the Parquet
scan's ReadSchema is pruned; filters written downstream are pushed into the
scan by Catalyst.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AGGREGATE_ENTITY, AGGREGATE_ENTITY_NAME, AGGREGATE_REGION

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def input_listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of change of every table under a folder, as its file system lists them:
    what a result kept for the session is valid for.  One call; a table in a folder has the
    time at which a file was last added to it or taken away."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the source tables to Spark SQL under their own names."""
    for n in names:
        spark.read.parquet(table_path(sf_dir, n)).createOrReplaceTempView(n)


def panel_microdata(spark: SparkSession, sf_dir: str, entity: str = "nation",
                    hit_threshold: float = 20.0, keys: Mapping[str, str] | None = None) -> DataFrame:
    """One row per line item: (entity, rf, ls, os, hit), and line item columns of ``keys`` under their new name.

    ``entity`` chooses the entity axis: ``nation`` (25 values, FIXTURES B1),
    ``supplier`` or ``customer`` (the high-cardinality variants of B4).

    Join order is chosen so that the line-item table is shuffled exactly once:
    orders are first enriched with their entity (a join keyed by customer that
    never touches line items), and only then joined to line items on the order
    key.  Nation is 25 rows by construction and is broadcast; customer and
    orders grow with the data, so the broadcast decision is left to the
    optimizer's size estimate and AQE.
    """
    keys = keys or {}
    li = read_table(spark, sf_dir, "lineitem", *dict.fromkeys(
        ["l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", *keys]))
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    hit = (F.col("l_quantity") > F.lit(hit_threshold)).cast("int")
    if entity == "nation":
        nation = F.broadcast(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name"))
        cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
        cust_ent = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
            "c_custkey", F.col("n_name").alias("entity"))
        ord_ent = orders.join(cust_ent, orders.o_custkey == cust_ent.c_custkey).select(
            "o_orderkey", "o_orderstatus", "entity")
        j = li.join(ord_ent, li.l_orderkey == ord_ent.o_orderkey)
    elif entity == "customer":
        ord_ent = orders.select("o_orderkey", "o_orderstatus",
                                F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("entity"))
        j = li.join(ord_ent, li.l_orderkey == ord_ent.o_orderkey)
    elif entity == "supplier":
        j = li.join(orders, li.l_orderkey == orders.o_orderkey).withColumn(
            "entity", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
    else:
        raise ValueError(f"unknown entity axis {entity!r}")
    return j.select("entity", F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"),
                    F.col("o_orderstatus").alias("os"), hit.alias("hit"), *[F.col(c).alias(n) for c, n in keys.items()])


def entity_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_entity: nations with their region plus the aggregate entity.

    25 + 1 rows (nation and region are fixed-size tables)."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = F.broadcast(read_table(spark, sf_dir, "region", "r_regionkey", "r_name"))
    nations = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("entity"),
        F.col("n_name").alias("entity_name"),
        F.lit(False).alias("is_aggregate"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso2"),
        F.col("r_name").alias("region"),
    )
    agg = spark.createDataFrame(
        [(AGGREGATE_ENTITY, AGGREGATE_ENTITY_NAME, True, None, AGGREGATE_REGION)],
        "entity string, entity_name string, is_aggregate boolean, iso2 string, region string")
    return nations.unionByName(agg)
