"""Declared constraints of a star schema and their report.

A table declares its keys, its columns that may not be null, the domains of its columns and its
references, as a schema's DDL would.  All row rules of a table (nulls and domains) are counted
in one aggregation over one scan.  Keys are checked in two steps: rows are grouped by a 64-bit
hash of the key, which is all that travels, and only the keys whose hash occurs more than once
are then compared as they are.  References go through ``fk_violations``, again one scan a child.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .expect import fk_violations


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table; a key may have several columns."""

    primary_key: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    not_null: Sequence[str] = ()
    #: conditions (SQL) that hold for a good row; an unknown (null) one is no violation, as in a CHECK
    domains: Sequence[str] = ()
    #: column -> (table, column)
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def keys(self) -> list[tuple[str, tuple[str, ...]]]:
        out = [("primary_key", tuple(self.primary_key))] if self.primary_key else []
        return out + [("unique", tuple(u)) for u in self.unique]

    def required(self) -> list[str]:
        """Columns without nulls: a primary key has none either."""
        return list(dict.fromkeys([*self.primary_key, *self.not_null]))


_SCHEMA = "table_name string, rule string, columns string"


def _row_rules(name: str, df: DataFrame, rules: TableRules) -> DataFrame | None:
    counts = [("not_null", c, F.col(f"`{c}`").isNull()) for c in rules.required()]
    counts += [("domain", good, ~F.expr(good)) for good in rules.domains]
    if not counts:
        return None
    one = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"v{i}") for i, (_, _, bad) in enumerate(counts)])
    rows = [F.struct(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.lit(label).alias("columns"),
                     F.col(f"v{i}").cast("long").alias("violations")) for i, (rule, label, _) in enumerate(counts)]
    return one.select(F.inline(F.array(*rows)))


def duplicate_rows(df: DataFrame, key: Sequence[str], nulls_differ: bool = True) -> DataFrame:
    """One row, ``violations``: rows beyond the first of each key.  With ``nulls_differ`` a key with a null
    equals no other, as in a UNIQUE constraint.

    A hash that occurs once is a key that occurs once.  The others, few in a sound table, are joined
    back by their hash and counted by the key itself, so keys of equal hash are told apart."""
    cols = [F.col(f"`{c}`") for c in key]
    src = df
    if nulls_differ:
        for c in cols:
            src = src.where(c.isNotNull())
    hashed = src.select(F.xxhash64(*cols).alias("_h"), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)]).alias("_key"))
    often = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    exact = (hashed.join(often, "_h", "left_semi").groupBy("_h", "_key").agg(F.count(F.lit(1)).alias("_n")))
    return exact.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("violations"))


def constraint_report(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """One row for each declared constraint: ``table_name, rule, columns, violations, status``."""
    parts: list[DataFrame] = []
    for name, r in rules.items():
        counted = _row_rules(name, tables[name], r)
        if counted is not None:
            parts.append(counted)
        for kind, key in r.keys():
            parts.append(duplicate_rows(tables[name], key).select(
                F.lit(name).alias("table_name"), F.lit(kind).alias("rule"), F.lit(",".join(key)).alias("columns"), "violations"))
    links = [(f"{name}|{c}|{parent}.{pk}", tables[name], c, tables[parent], pk)
             for name, r in rules.items() for c, (parent, pk) in r.references.items()]
    if links:
        at = F.split("fk", r"\|")
        parts.append(fk_violations(links).select(
            at[0].alias("table_name"), F.lit("reference").alias("rule"), F.concat_ws("->", at[1], at[2]).alias("columns"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))


def raise_on_violation(report: DataFrame) -> None:
    """What a database does on insert: fails, naming the constraints that don't hold."""
    bad = report.where("status <> 'pass'").collect()  # at most a row for each constraint
    if bad:
        raise AssertionError("; ".join(f"{r.table_name}.{r.rule}({r.columns}): {r.violations}" for r in bad))
