"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the
session's shared checkpoint folder as Parquet and rereads it as the next stage's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelgap.llm.decontaminate import decontaminate
from panelgap.llm.mixing import mixed
from panelgap.llm.quality import quality_filter
from panelgap.llm.queries import SHARDS
from panelgap.llm.sharding import shard
from panelgap.llm.simhash import drop_near_duplicates
from panelgap.session import ensure_checkpoint_dir
from panelgap.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: 3-word shingles, up to 3 bits."""
    return drop_near_duplicates(docs, shingle_words=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources reach their target words."""
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot."""
    return shard(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: SimHash, the spaced seeds and the dual solution can't be said in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
