"""ML sample.

Rows are the reliable cells with a value; the binary label is ``value <
threshold`` where the threshold defaults to the exact median of the
non-aggregate cells (the reference's fixed 85 does not split the test data).
Features are the four categorical axes label-encoded in alphabetical order.
Folds are deterministic and stratified: inside each class, rows are numbered
by md5 of their key and dealt round-robin into ``n_folds`` folds; fold 0 is
the 20 % test split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantile import exact_quantile
from ..operators.rank import global_row_number, rank_by

FEATURES = ("level", "ls", "os", "entity")
#: Axes of the cube: their values are codes of the panel, not data.
FIXED = ("level", "ls", "os")
CODES = tuple(f"{c}_code" for c in FEATURES)


def label_rows(fact: DataFrame, threshold: float | Column | None = None, ref_level: str = "L_NONE",
               value: str = "pct") -> DataFrame:
    if threshold is None:
        threshold = exact_quantile(fact.where(~F.col("is_aggregate")), value, 0.5).scalar()
    elif not isinstance(threshold, Column):
        threshold = F.lit(float(threshold))
    rows = fact.where(F.col("is_reliable") & F.col(value).isNotNull())
    return rows.select(
        "entity", "category_code", "level", "ls", "os", value,
        F.md5(F.concat_ws("|", "entity", "category_code")).alias("key"),
        F.when(F.col(value) < threshold, 1).otherwise(0).cast("long").alias("label"),
        (F.col("level") != F.lit(ref_level)).cast("long").alias("has_level"))


def label_encode(df: DataFrame, cols: Sequence[str] = FEATURES, fixed: Sequence[str] = FIXED) -> DataFrame:
    """M8: alphabetical codes 0..n-1 per column (LabelEncoder semantics).

    A ``fixed`` axis has a handful of values whatever the data: its sorted values are one
    array, a code is a place in it, and nothing is joined.  For the others
    the dictionary stays distributed: distinct values of each column are
    numbered with the distributed ordinal and joined back, so no column's
    distinct values ever pass through the driver (``StringIndexer`` would
    collect them, which an entity axis of customers cannot afford).  The
    optimizer broadcasts the small dictionaries and shuffles the large ones.
    Rows with a NULL feature are dropped, as an encoder rejects them."""
    out = df
    for c in cols:
        if c in fixed:
            values = df.agg(F.sort_array(F.collect_set(c))).scalar()
            out = out.withColumn(f"{c}_code", F.array_position(values, F.col(c)) - F.lit(1)).where(F.col(c).isNotNull())
            continue
        vals = df.select(c).where(F.col(c).isNotNull()).distinct()
        codes = global_row_number(vals, [F.col(c).asc()], "_code").select(
            c, (F.col("_code") - F.lit(1)).cast("long").alias(f"{c}_code"))
        out = out.join(codes, c)
    return out


def assign_folds(df: DataFrame, n_folds: int = 5, label: str = "label", key: str = "key") -> DataFrame:
    """Stratified deterministic folds (distributed row number inside
    each class; no single-partition window even for one huge class)."""
    r = rank_by(df, key, descending=False, tiebreak=["entity", "category_code"], method="row_number",
                out="_rn", partition_by=label)
    return (r.withColumn("fold", ((F.col("_rn") - 1) % n_folds).cast("long"))
            .withColumn("is_test", F.col("fold") == 0).drop("_rn"))


def ml_frame(fact: DataFrame, threshold=None, n_folds: int = 5) -> DataFrame:
    return assign_folds(label_encode(label_rows(fact, threshold)), n_folds)
