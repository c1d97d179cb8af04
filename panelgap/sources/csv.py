"""CSV sources (S1, S2): raw all-string reader and typed reader.

No ``inferSchema`` anywhere: inference is an extra full pass over the data
and is not stable across files.  The raw reader takes the header from the
file and types every column as STRING; the typed reader takes an explicit
schema.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.clean import null_na_tokens


def read_raw_csv(spark: SparkSession, path: str, keep_tokens=("geo", "ind_type")) -> DataFrame:
    """Every column as string; a missing path is an error; the missing-
    value tokens a pandas reader would null become NULL except in code columns."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    df = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
    return null_na_tokens(df, keep=[c for c in keep_tokens if c in header])


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV with an explicit schema; malformed values become NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
