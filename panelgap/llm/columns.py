"""Columns of tables whose other columns may have any name and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def compared(docs: DataFrame):
    """How the session compares column names: as they are, or without case."""
    exact = docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda c: c) if exact else str.lower


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of the type; maps it doesn't."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.UserDefinedType))
