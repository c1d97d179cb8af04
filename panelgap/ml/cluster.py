"""Entity profiles: standardisation, K-Means with restarts, elbow, silhouette
(M1-M7, W4, A7).

* Standardisation uses the population standard deviation (as the reference's
  scaler); the (mean, std) pair per feature is one scalar-subquery row.
* MLlib's KMeans runs one initialisation; restarts are a loop over seeds
  keeping the smallest training cost (sum of squared distances = inertia).
* Silhouette is the squared-Euclidean one (MLlib's definition), computed from
  per-cluster sums: O(n * k) work with the k cluster summaries attached to each
  point as one array (bounded by k) -- never pairwise.  The reference's exact
  Euclidean silhouette measures every pair of points; ``silhouette_euclid`` does so
  by blocks, up to a stated number of points.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CLUSTER_NAMES = ("High inclusion", "Medium inclusion", "Low inclusion")


def standardize(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])).scalar()
    out = df
    for i, c in enumerate(cols):
        s = stats.getField(f"s{i}")
        out = out.withColumn(c + suffix, F.when(s == 0, F.lit(0.0))
                             .otherwise((F.col(c) - stats.getField(f"m{i}")) / s))
    return out


def _features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Assembled feature vectors, checkpointed: K-Means runs ~15 jobs per fit
    (initialisation, iterations, summary), and each would otherwise re-plan
    the standardisation's subqueries; the checkpoint cuts that lineage once
    (about 3x faster per fit) and survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).checkpoint(eager=True)


def kmeans_restarts(df: DataFrame, cols: Sequence[str], k: int, seeds: Sequence[int] = range(42, 52),
                    max_iter: int = 300, tol: float = 1e-4):
    """Fit K-Means once per seed; return (best model, best cost, features DF)."""
    vec = _features(df, cols)

    def fit(s):
        m = KMeans(k=k, seed=s, maxIter=max_iter, tol=tol, initMode="k-means||",
                   featuresCol="features", predictionCol="cluster_raw").fit(vec)
        return s, m, m.summary.trainingCost

    # restarts are independent fits: submit them as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=min(8, len(seeds))) as pool:
        fits = list(pool.map(fit, seeds))
    best, best_cost = None, None
    for _, m, cost in fits:                      # seed order: first best wins ties
        if best_cost is None or cost < best_cost - 1e-12:
            best, best_cost = m, cost
    return best, best_cost, vec


def kmeans_grid(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seeds: Sequence[int] = range(42, 52),
                max_iter: int = 300, tol: float = 1e-4, workers: int = 8):
    """Best-of-restarts K-Means for several k at once: every (k, seed) fit is
    an independent job, all submitted to one pool.  Returns {k: (model, cost)}
    and the assembled features."""
    vec = _features(df, cols)

    def fit(ks_):
        k, s = ks_
        m = KMeans(k=k, seed=s, maxIter=max_iter, tol=tol, initMode="k-means||",
                   featuresCol="features", predictionCol="cluster_raw").fit(vec)
        return k, s, m, m.summary.trainingCost

    with ThreadPoolExecutor(max_workers=workers) as pool:
        fits = list(pool.map(fit, [(k, s) for k in ks for s in seeds]))
    best: dict = {}
    for k, _, m, cost in fits:                   # (k, seed) order: first best wins ties
        if k not in best or cost < best[k][1] - 1e-12:
            best[k] = (m, cost)
    return best, vec


def relabel_by_mean(pred: DataFrame, by: str, raw: str = "cluster_raw", out: str = "cluster",
                    names: Sequence[str] | None = CLUSTER_NAMES) -> DataFrame:
    """Renumber clusters 0..k-1 by ascending mean of ``by`` (k rows)."""
    means = pred.groupBy(raw).agg(F.avg(by).alias("_m"))
    # k rows: a single-partition window is bounded by the number of clusters
    order = means.select(raw, F.row_number().over(Window.orderBy("_m", raw)).alias("_r"))
    res = pred.join(F.broadcast(order), raw).withColumn(out, (F.col("_r") - 1).cast("long")).drop("_r")
    if names:
        m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
        res = res.withColumn("group_name", m[F.col(out)])
    return res


def silhouette_sq(df: DataFrame, cols: Sequence[str], cluster: str) -> DataFrame:
    """Mean squared-Euclidean silhouette (one row, column ``silhouette``).
    A point alone in its cluster scores 0."""
    x2 = sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0))
    stats = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                    *[F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)],
                                    F.sum(x2).alias("q"))
    arr = stats.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "q",
                                            *[f"s{i}" for i in range(len(cols))]))).scalar()
    p = df.withColumn("_x2", x2).withColumn("_cl", arr)

    def mean_d(s):
        dot = sum((F.col(c) * s[f"s{i}"] for i, c in enumerate(cols)), F.lit(0.0))
        return F.col("_x2") - F.lit(2.0) * dot / s["n"] + s["q"] / s["n"]

    own = F.filter("_cl", lambda s: s["c"] == F.col(cluster))[0]
    others = F.filter("_cl", lambda s: s["c"] != F.col(cluster))
    a = F.when(own["n"] > 1, mean_d(own) * own["n"] / (own["n"] - 1)).otherwise(F.lit(0.0))
    b = F.array_min(F.transform(others, mean_d))
    s = (F.when(own["n"] <= 1, F.lit(0.0))
         .when(a < b, F.lit(1.0) - a / b).when(a > b, b / a - F.lit(1.0)).otherwise(F.lit(0.0)))
    return p.select(s.alias("_s")).agg(F.avg("_s").alias("silhouette"))


#: Points that the Euclidean silhouette takes at most, as it measures every distance, and points to a block.
MAX_POINTS, BLOCK_POINTS = 200_000, 2048


def silhouette_euclid(df: DataFrame, cols: Sequence[str], cluster: str, key: str, max_points: int = MAX_POINTS,
                      block_points: int = BLOCK_POINTS) -> DataFrame:
    """Mean Euclidean silhouette (one row, column ``silhouette``); ``key`` tells points apart.

    Points of a cluster are gathered in blocks of about ``block_points``, as arrays.  Every point meets every
    block once, by an equi-join on the block's number, and only the sum of its distances comes out:
    points x blocks rows, never pairs.  The work still grows with the square of the points, so more than
    ``max_points`` are refused; ``silhouette_sq`` has no such bound.  A point alone in its cluster scores 0."""
    ensure_checkpoint_dir(df.sparkSession)
    pts = df.select(F.col(key).alias("_k"), F.col(cluster).alias("_c"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x")).checkpoint()
    n = pts.count()
    if n > max_points:
        raise ValueError(f"{n} points are more than the {max_points} that every distance can be measured for")
    blocks = max(1, -(-n // block_points))
    dealt = (pts.groupBy("_c", F.pmod(F.xxhash64("_k"), F.lit(blocks)).alias("_b"))
             .agg(F.collect_list("_x").alias("_pts")).withColumnRenamed("_c", "_other"))
    steps = lambda q: F.zip_with("_x", q, lambda a, b: (a - b) * (a - b))
    far = F.aggregate("_pts", F.lit(0.0), lambda s, q: s + F.sqrt(F.aggregate(steps(q), F.lit(0.0), lambda u, v: u + v)))
    met = (pts.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(dealt, "_b")
           .select("_k", "_c", "_other", far.alias("_d"), F.size("_pts").alias("_n"))
           .groupBy("_k", "_c", "_other").agg(F.sum("_d").alias("_d"), F.sum("_n").alias("_n")))
    own = F.col("_c") == F.col("_other")
    one = met.groupBy("_k").agg(F.max(F.when(own, F.col("_n"))).alias("_size"),
                                F.max(F.when(own, F.col("_d") / F.greatest(F.col("_n") - 1, F.lit(1)))).alias("_a"),
                                F.min(F.when(~own, F.col("_d") / F.col("_n"))).alias("_o"))
    top = F.greatest("_a", "_o")
    score = F.when((F.col("_size") == 1) | F.col("_o").isNull() | (top == 0), 0.0).otherwise((F.col("_o") - F.col("_a")) / top)
    return one.agg(F.avg(score).alias("silhouette"))
