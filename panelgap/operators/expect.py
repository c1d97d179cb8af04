"""Data-quality expectations (E1-E10) and referential integrity.

``check_panel`` returns one row per check: (check, violations, status).
All row-level checks share ONE aggregation pass; key uniqueness is one
aggregation; each foreign key is a left-anti join.  Nothing is collected: the
result is a small DataFrame, and ``raise_on_fail`` is an explicit action for
callers that want the reference's assertion behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = "check_name string, violations bigint"


def _rows(df: DataFrame, pairs: Sequence[tuple[str, object]]) -> DataFrame:
    """Turn one-row aggregates into (check, violations) rows with ``stack``."""
    args = ", ".join(f"'{name}', CAST({expr} AS BIGINT)" for name, expr in pairs)
    return df.selectExpr(f"stack({len(pairs)}, {args}) AS (check_name, violations)")


def check_panel(panel: DataFrame, entity_dim: DataFrame, category_dim: DataFrame,
                n_categories: int, allowed_null_categories: Sequence[str],
                required: Sequence[str] = (), entity: str = "entity", category: str = "category_code",
                value: str = "pct", flag: str = "quality_flag", reliable: str = "is_reliable",
                low: float = 0.0, high: float = 100.0, flag_domain: Sequence[str] = ("u",)) -> DataFrame:
    spark = panel.sparkSession
    # dimensions are joined without a broadcast hint: the optimizer broadcasts
    # them when its size estimate is under the threshold, and AQE re-plans at
    # run time from the real sizes
    n_ent = entity_dim.agg(F.count(F.lit(1)).alias("n_ent_expected"))
    row = panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(entity)).alias("n_ent"),
        F.count_if(F.col(value).isNotNull() & ~F.col(value).between(low, high)).alias("out_of_range"),
        F.count_if(F.col(value).isNull() & ~F.col(category).isin(*allowed_null_categories)
                   if allowed_null_categories else F.col(value).isNull()).alias("bad_nulls"),
        F.count_if(F.col(entity).isNull() | F.col(category).isNull()).alias("null_keys"),
        F.count_if(F.col(flag).isNotNull() & ~F.col(flag).isin(*flag_domain)).alias("bad_flags"),
    )
    # n_ent_expected is one row: attach it as an uncorrelated scalar subquery
    row = row.withColumn("n_ent_expected", n_ent.scalar())
    row_checks = _rows(row, [
        ("E1_row_count", f"abs(n_rows - n_ent_expected * {n_categories})"),
        ("E2_entity_count", "abs(n_ent - n_ent_expected)"),
        ("E4_value_range", "out_of_range"),
        ("E5_null_categories", "bad_nulls"),
        ("E8_not_null_keys", "null_keys"),
        ("E8_flag_domain", "bad_flags"),
    ])
    dup = (panel.groupBy(entity, category).agg(F.count(F.lit(1)).alias("c"))
           .agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("dups")))
    def orphans(key: str, dim: DataFrame) -> DataFrame:
        """Rows whose key the dimension lacks: keys are counted map-side before they meet it."""
        counts = panel.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        known = dim.select(key, F.lit(True).alias("hit")).distinct()
        return (counts.join(known, key, "left").where("hit is null")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v")))

    fk_e, fk_c = orphans(entity, entity_dim), orphans(category, category_dim)
    schema = {f.name: f.dataType for f in panel.schema.fields}
    missing = [c for c in required if c not in schema]
    literal = spark.createDataFrame(
        [("E3_reliable_is_boolean", 0 if isinstance(schema.get(reliable), T.BooleanType) else 1),
         ("E10_required_columns", len(missing))], CHECK_SCHEMA)
    out = (row_checks
           .unionByName(_rows(dup, [("E6_unique_key", "dups")]))
           .unionByName(_rows(fk_e, [("E7_fk_entity", "v")]))
           .unionByName(_rows(fk_c, [("E7_fk_category", "v")]))
           .unionByName(literal))
    return out.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))


def raise_on_fail(checks: DataFrame) -> None:
    failed = checks.where(F.col("status") != "pass").collect()  # at most #checks rows
    if failed:
        raise AssertionError("expectations failed: " + ", ".join(f"{r.check_name}={r.violations}" for r in failed))


def fk_violations(keys: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key (name, violations) = child rows whose key
    has no parent.  Each child frame is read once, for all its keys: a row is
    turned into (key number, value) pairs, which are counted map-side (a value
    holding a third of the rows becomes one row per task) before the shuffle;
    parents are joined to the counts on the same key.  Whole numbers travel as
    such, other values as text."""
    spark = keys[0][1].sparkSession
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    found = None
    for as_type in ("long", "string"):
        mine = [(i, k) for i, k in enumerate(keys)
                if isinstance(k[1].schema[k[2]].dataType, whole) == (as_type == "long")]
        children: dict[int, list] = {}
        for i, k in mine:
            children.setdefault(id(k[1]), []).append((i, k))
        counts = parents = None
        for group in children.values():
            pairs = [F.struct(F.lit(i).alias("fk"), F.col(k[2]).cast(as_type).alias("k")) for i, k in group]
            one = (group[0][1][1].select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("k is not null")
                   .groupBy("fk", "k").agg(F.count(F.lit(1)).alias("n")))
            counts = one if counts is None else counts.unionByName(one)
        for i, (_, _, _, parent, pk) in mine:
            one = parent.select(F.lit(i).alias("fk"), F.col(pk).cast(as_type).alias("k"), F.lit(True).alias("hit"))
            parents = one if parents is None else parents.unionByName(one)
        if counts is None:
            continue
        # left join + IS NULL rather than left_anti: Catalyst would push an
        # anti join below the aggregation and shuffle raw child rows again
        lost = (counts.join(parents, ["fk", "k"], "left").where("hit is null")
                .groupBy("fk").agg(F.sum("n").alias("violations")))
        found = lost if found is None else found.unionByName(lost)
    names = spark.createDataFrame([(i, k[0]) for i, k in enumerate(keys)], "i int, name string")
    return (names.join(found, F.col("i") == F.col("fk"), "left")
            .select(F.col("name").alias("fk"), F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))
