"""Registry of named queries: a Spark builder and (optionally) its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, note: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, note)
        return fn
    return deco
