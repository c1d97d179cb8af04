"""Ranking operators (W1-W5) without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY ...)`` and ``RANK() OVER (ORDER BY ...)`` with no
PARTITION BY make Spark move every row into one task.  Here a global ordinal is
computed in three distributed steps:

1. ``orderBy`` range-partitions on the *full* sort key -- value, tie-break
   columns, then a hash of the row -- so sampled bounds split even a value held
   by a third of the rows across tasks, and sorts each partition; the result is
   checkpointed to the session's checkpoint folder so that the positions below
   are stable even if an executor is lost;
2. ``monotonically_increasing_id`` gives (partition index, position) and one
   aggregation counts rows per partition -> O(#partitions) rows;
3. a prefix sum over those counts is broadcast back (its size is bounded by the
   number of partitions, not by the data).

RANK is then the smallest ordinal of each tie group: found per (sorted partition,
value) first, then per value, and joined back on value and partition, so the rows of
a hot value stay spread as the sort left them.  Ordinals within groups (``partition_by``) subtract the
count of rows that precede the group in the global order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_POS_BITS = 33


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def global_row_number(df: DataFrame, order: Sequence[Column | str], out: str = "rn",
                      part_out: str | None = None) -> DataFrame:
    """Append ``out`` = 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (unique keys) if the result should not
    depend on how ties are broken."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sorted_df = df.orderBy(*[_col(c) for c in order]).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    with_id = sorted_df.withColumn("_mid", mid)
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = with_id.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    # one row per partition: the window below runs over O(#partitions) rows
    offsets = counts.select(
        "_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0)).alias("_off"))
    res = (with_id.withColumn("_p", part).withColumn("_pos", pos)
           .join(F.broadcast(offsets), "_p")
           .withColumn(out, (F.col("_off") + F.col("_pos") + F.lit(1)).cast("long"))
           .drop("_mid", "_pos", "_off"))
    return res.withColumnRenamed("_p", part_out) if part_out else res.drop("_p")


def _with_first(rn: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Adds the first ordinal of each group of equal (or null) ``keys``.

    By way of one row per (sorted partition, group): a hot group spans many
    partitions, and its rows find their row by group and partition."""
    local = rn.groupBy(*keys, "_part").agg(F.min("_rn").alias("_first"))
    whole = local.groupBy(*[F.col(k).alias(f"{k}_t") for k in keys]).agg(F.min("_first").alias(out))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_t"))
    spots = local.drop("_first").join(whole, same).drop(*keys).withColumnRenamed("_part", "_part_t")
    return (rn.join(spots, same & (F.col("_part") == F.col("_part_t")))
            .drop("_part_t", *[f"{k}_t" for k in keys]))


def rank_by(df: DataFrame, value: str, descending: bool = True,
            tiebreak: Sequence[str] = (), method: str = "rank", out: str = "rank",
            partition_by: str | None = None, row_number_out: str | None = None) -> DataFrame:
    """RANK / ROW_NUMBER by ``value`` (NULLS LAST when descending, FIRST when
    ascending, as in Spark and SQLite), optionally within ``partition_by``
    groups.  ``method='row_number'`` orders ties by ``tiebreak``.  With
    ``method='rank'`` and ``row_number_out``, the ROW_NUMBER of the same sort
    is kept as well, so both come out of one global sort."""
    v = F.col(value)
    key = v.desc_nulls_last() if descending else v.asc_nulls_first()
    # last sort key: a deterministic hash of the whole row.  RANK does not
    # depend on the order inside a tie group, but the range partitioner can
    # only split a hot value across tasks if its rows have distinct keys; it
    # also makes ROW_NUMBER without a tie-break reproducible.
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = ([F.col(partition_by).asc_nulls_first()] if partition_by else []) + [key] + \
            [F.col(t).asc_nulls_first() for t in tiebreak] + [salt.asc()]
    rn = global_row_number(df, order, "_rn", part_out="_part")
    group_keys = [partition_by] if partition_by else []
    if partition_by:
        # rows before each group in the global order
        rn = _with_first(rn, group_keys, "_g0")
        rn = rn.withColumn("_rn", F.col("_rn") - F.col("_g0") + F.lit(1)).drop("_g0")
    if method == "row_number":
        return rn.withColumnRenamed("_rn", out).drop("_part")
    if method != "rank":
        raise ValueError(method)
    res = _with_first(rn, [*group_keys, value], "_r").drop("_part")
    res = res.withColumn(out, F.col("_r").cast("long"))
    if row_number_out:
        res = res.withColumnRenamed("_rn", row_number_out)
    return res.drop("_rn", "_r")


def rank_where(df: DataFrame, cond: Column, value: str, out: str, descending: bool = True,
               tiebreak: Sequence[str] = (), method: str = "rank") -> DataFrame:
    """Rank only the rows where ``cond`` holds; other rows get NULL (W2/W3:
    the aggregate entity stays in the output but takes no position)."""
    ranked = rank_by(df.where(cond), value, descending, tiebreak, method, out)
    rest = df.where(~cond | cond.isNull()).withColumn(out, F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """Global top-k: per-partition heaps + merge (TakeOrderedAndProject)."""
    return df.orderBy(*[_col(c) for c in order]).limit(k)


def top_k_per_group(df: DataFrame, group: str | Sequence[str], k: int, order: Sequence[Column | str],
                    out: str = "rank") -> DataFrame:
    """Per-group top-k by RANK <= k.

    Spark plans a ``WindowGroupLimit`` below the exchange, so each map task
    forwards at most k rows per group (plus ties): a hot group never ships
    more than k rows per task to the window."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*[_col(c) for c in order])
    return df.withColumn(out, F.rank().over(w).cast("long")).where(F.col(out) <= k)
