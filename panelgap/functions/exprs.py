"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# pandas' read_csv turns these tokens into missing values even with dtype=str;
# Spark's CSV reader only nulls empty fields.  Fixed values.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, d: int = 2) -> Column:
    """ROUND half-up, as SQLite and DuckDB (on the printed value)."""
    return F.round(col(c), d)


def complement(c, d: int | None = 2, total: float = 100.0) -> Column:
    """100 - x (P22), rounded last."""
    e = F.lit(total) - col(c)
    return F.round(e, d) if d is not None else e


def diff(a, b, d: int | None = 2) -> Column:
    """Null-propagating difference a - b."""
    e = col(a) - col(b)
    return F.round(e, d) if d is not None else e


def strip(c) -> Column:
    """Python ``str.strip()``: remove all leading/trailing whitespace."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")
