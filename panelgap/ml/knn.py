"""Exact k-nearest-neighbour classification by a k-d tree.

MLlib has no k-NN and the brute force (every test row x every train row) is a cross
join.  Here the space of the train profiles is cut into cells by a k-d tree:

1. train rows are reduced to at most k rows per profile (the k smallest keys;
   ``WindowGroupLimit`` caps each map task's output per profile, so a hot
   profile never travels whole);
2. the splits of the tree come from a bounded sample of the profiles, so that the cells
   have about equally many; the least and greatest profile of each cell, its box, come
   from all of them;
3. predictions are made per *distinct* test profile: it meets the rows of its own cell,
   an equi-join on the cell, and the k-th distance there is an upper bound;
4. cells whose box lies within that bound are the only others that can hold a nearer
   row (or a tie, which the smaller key wins); it meets those in a second join.

So there are two joins whatever the data are, and every cell that is left out lies farther
away than k rows that were found.  Ties in distance are broken by the train key, the
vote by the smaller label.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import top_k_per_group
from ..session import ensure_checkpoint_dir

#: Profiles to a cell, cells at most, and profiles of the sample that places the splits.
CELL_PROFILES, MAX_CELLS, SAMPLE_PROFILES = 256, 256, 20_000


def kd_splits(points: np.ndarray, cells: int) -> list:
    """Nested ``[feature, cut, below, above]`` (values up to the cut go below), or a cell's number."""
    number = iter(range(1 << 30))

    def grow(rows: np.ndarray, wanted: int):
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(1)
        if wanted < 2 or not spread.max():
            return next(number)
        f = int(spread.argmax())
        values = np.unique(rows[:, f])
        cut = min(np.median(rows[:, f]), values[-2])  # something stays above
        low = rows[:, f] <= cut
        return [f, float(cut), grow(rows[low], wanted // 2), grow(rows[~low], wanted - wanted // 2)]

    return grow(points, cells)


def _cell(tree, values: Sequence[Column]) -> Column:
    if not isinstance(tree, list):
        return F.lit(tree)
    f, cut, below, above = tree
    return F.when(values[f] <= F.lit(cut), _cell(below, values)).otherwise(_cell(above, values))


def knn_predict(train: DataFrame, test: DataFrame, features: Sequence[str], k: int = 5,
                label: str = "label", key: str = "key", cell_profiles: int = CELL_PROFILES,
                out: str = "prediction") -> DataFrame:
    """``test`` with ``out``, the label of most of the k nearest train rows."""
    features = list(features)
    ensure_checkpoint_dir(train.sparkSession)
    t_cols = [f"_t{i}" for i in range(len(features))]
    reduced = top_k_per_group(train.select(*features, label, key), features, k, [F.col(key).asc()],
                              out="_kr").drop("_kr").checkpoint()
    profiles = reduced.select(*features).distinct()
    n = profiles.count()
    if not n:
        raise ValueError("empty train set")
    cells = min(MAX_CELLS, -(-n // cell_profiles))
    tree = 0
    if cells > 1:  # about as many rows as the sample may have, by a hash, from all partitions
        chosen = profiles.where(F.pmod(F.xxhash64(*features), F.lit(n)) < SAMPLE_PROFILES).limit(2 * SAMPLE_PROFILES)
        tree = kd_splits(np.array([list(r) for r in chosen.collect()], float).reshape(-1, len(features)), cells)
    placed = reduced.withColumn("_cell", _cell(tree, [F.col(f) for f in features]))
    # one row for each cell: the box of its profiles
    boxes = placed.groupBy("_cell").agg(*[F.min(f).alias(f"_lo{i}") for i, f in enumerate(features)],
                                        *[F.max(f).alias(f"_hi{i}") for i, f in enumerate(features)]).collect()
    asked = (test.select(*[F.col(f).alias(t) for f, t in zip(features, t_cols)]).distinct()
             .withColumn("_home", _cell(tree, [F.col(t) for t in t_cols])))
    d2 = sum(((F.col(t) - F.col(f)) * (F.col(t) - F.col(f)) for t, f in zip(t_cols, features)), F.lit(0)).cast("long")
    nearest = Window.partitionBy(*t_cols).orderBy(F.col("_d2").asc(), F.col(key).asc())

    def best(met: DataFrame) -> DataFrame:
        return met.withColumn("_rn", F.row_number().over(nearest)).where(F.col("_rn") <= k).drop("_rn")

    own = best(asked.join(placed, F.col("_home") == F.col("_cell")).withColumn("_d2", d2)).select(*t_cols, "_home", label, key, "_d2")
    found = own
    if len(boxes) > 1:
        own = own.checkpoint()
        # without k rows at home there is no bound yet
        bound = own.groupBy(*t_cols).agg(F.when(F.count(F.lit(1)) >= k, F.max("_d2")).alias("_bound"))

        def away(box) -> Column:
            steps = [F.greatest(F.lit(box[f"_lo{i}"]) - F.col(t), F.col(t) - F.lit(box[f"_hi{i}"]), F.lit(0)) for i, t in enumerate(t_cols)]
            return sum((s * s for s in steps), F.lit(0)).cast("long")

        near = F.array(*[F.when((F.lit(b["_cell"]) != F.col("_home")) & (F.col("_bound").isNull() | (away(b) <= F.col("_bound"))), F.lit(b["_cell"]))
                         for b in boxes])
        others = (asked.join(bound, t_cols, "left").withColumn("_other", F.explode(F.array_compact(near)))
                  .join(placed, F.col("_other") == F.col("_cell")).withColumn("_d2", d2)
                  .where(F.col("_bound").isNull() | (F.col("_d2") <= F.col("_bound")))
                  .select(*t_cols, "_home", label, key, "_d2"))
        found = best(own.unionByName(others))
    votes = found.groupBy(*t_cols, label).agg(F.count(F.lit(1)).alias("_v"))
    wv = Window.partitionBy(*t_cols).orderBy(F.col("_v").desc(), F.col(label).asc())
    winner = (votes.withColumn("_r", F.row_number().over(wv)).where(F.col("_r") == 1)
              .select(*[F.col(t).alias(f) for t, f in zip(t_cols, features)], F.col(label).alias(out)))
    return test.join(winner, features, "left")
