"""Profile modelling queries: encoding, folds, k-NN and its reports,
clustering, tree models.  Deterministic ones carry a SQL oracle (brute force
for k-NN); the MLlib fits are checked rows-only plus invariants in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml.cluster import kmeans_grid, kmeans_restarts, relabel_by_mean, silhouette_euclid, silhouette_sq, standardize
from ..ml.evaluate import accuracy_by_group as acc_by_group
from ..ml.evaluate import confusion, majority_baseline as majority, report
from ..ml.knn import knn_predict as knn
from ..ml.sample import CODES, FEATURES
from ..ml.scoring import fit_scorer, score_profiles
from ..ml.trees import compare_models, feature_importance as importances, profile_scores as scores
from ..ml.trees import results_table, tree_rules as rules
from . import model
from . import oracle as O
from .registry import query

FEATURE_NAMES = ["level", "ls", "os", "entity"]

ML_SQL = """
, thr AS (SELECT QUANTILE_CONT(pct, 0.5) AS t FROM fact WHERE NOT is_aggregate),
ml0 AS (
  SELECT entity, category_code, level, ls, os, pct, MD5(entity || '|' || category_code) AS key,
         CAST(CASE WHEN pct < (SELECT t FROM thr) THEN 1 ELSE 0 END AS BIGINT) AS label,
         CAST(level <> 'L_NONE' AS BIGINT) AS has_level
  FROM fact WHERE is_reliable AND pct IS NOT NULL),
mlf AS (
  SELECT *, CAST(DENSE_RANK() OVER (ORDER BY level) - 1 AS BIGINT) AS level_code,
         CAST(DENSE_RANK() OVER (ORDER BY ls) - 1 AS BIGINT) AS ls_code,
         CAST(DENSE_RANK() OVER (ORDER BY os) - 1 AS BIGINT) AS os_code,
         CAST(DENSE_RANK() OVER (ORDER BY entity) - 1 AS BIGINT) AS entity_code,
         CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY key, entity, category_code) - 1) % 5 AS BIGINT) AS fold
  FROM ml0),
mls AS (SELECT *, fold = 0 AS is_test FROM mlf)"""

KNN_SQL = ML_SQL + """,
tr AS (SELECT * FROM mls WHERE NOT is_test),
te AS (SELECT * FROM mls WHERE is_test),
d AS (
  SELECT te.entity, te.category_code, te.label, te.level, tr.label AS rl, tr.key AS rk,
         (te.level_code - tr.level_code) * (te.level_code - tr.level_code)
         + (te.ls_code - tr.ls_code) * (te.ls_code - tr.ls_code)
         + (te.os_code - tr.os_code) * (te.os_code - tr.os_code)
         + (te.entity_code - tr.entity_code) * (te.entity_code - tr.entity_code) AS d2
  FROM te CROSS JOIN tr),
nn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity, category_code ORDER BY d2, rk) AS rn FROM d),
v AS (SELECT entity, category_code, label, level, rl, COUNT(*) AS c FROM nn WHERE rn <= 5 GROUP BY 1, 2, 3, 4, 5),
pred AS (
  SELECT entity, category_code, label, level, rl AS prediction
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity, category_code ORDER BY c DESC, rl) AS r FROM v)
  WHERE r = 1),
conf AS (
  SELECT a.label, b.prediction, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
  FROM (VALUES (0), (1)) AS a(label) CROSS JOIN (VALUES (0), (1)) AS b(prediction)
  LEFT JOIN (SELECT label, prediction, COUNT(*) AS n FROM pred GROUP BY 1, 2) c
    ON c.label = a.label AND c.prediction = b.prediction)"""


def _ml(spark, sf_dir):
    return model.ml_frame(spark, sf_dir)


# ------------------------------------------------------------ encoding ----
def label_encode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ml(spark, sf_dir).select("entity", "category_code", "pct", "key", "label", "has_level", *CODES)


query("label_encode", O.with_fact(ML_SQL + """
SELECT entity, category_code, pct, key, label, has_level, level_code, ls_code, os_code, entity_code
FROM mls"""))(label_encode_q)


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ml(spark, sf_dir).select("entity", "category_code", "label", "fold", "is_test")


query("stratified_folds", O.with_fact(ML_SQL + """
SELECT entity, category_code, label, fold, is_test FROM mls"""))(stratified_folds)


def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return majority(_ml(spark, sf_dir))


query("majority_baseline", O.with_fact(ML_SQL + """
, cb AS (SELECT label, COUNT(*) AS n FROM mls GROUP BY label)
SELECT CAST(MAX(n) AS BIGINT) AS majority_n, CAST(SUM(n) AS BIGINT) AS total,
       ROUND(MAX(n) / SUM(n), 6) AS majority_accuracy FROM cb"""))(majority_baseline)


# ----------------------------------------------------------------- k-NN ----
def _knn(spark, sf_dir):
    key = model._key(spark, sf_dir, "knn")
    if key not in model._CACHE:
        ml = _ml(spark, sf_dir)
        pred = knn(ml.where(~F.col("is_test")), ml.where(F.col("is_test")), CODES, k=5)
        model._CACHE[key] = pred.checkpoint()
    return model._CACHE[key]


def knn_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir).select("entity", "category_code", "label", "prediction")


query("knn_predict", O.with_fact(KNN_SQL + """
SELECT entity, category_code, label, prediction FROM pred"""))(knn_predict)


def knn_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion(_knn(spark, sf_dir))


query("knn_confusion", O.with_fact(KNN_SQL + "\nSELECT label, prediction, n FROM conf"))(knn_confusion)


def knn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(confusion(_knn(spark, sf_dir)))


query("knn_report", O.with_fact(KNN_SQL + """,
per AS (
  SELECT t.cls, t.tp, t.support, p.npred,
         CASE WHEN p.npred = 0 THEN 0.0e0 ELSE t.tp * 1.0e0 / p.npred END AS precision,
         CASE WHEN t.support = 0 THEN 0.0e0 ELSE t.tp * 1.0e0 / t.support END AS recall
  FROM (SELECT label AS cls, SUM(CASE WHEN label = prediction THEN n END) AS tp, SUM(n) AS support
        FROM conf GROUP BY label) t
  JOIN (SELECT prediction AS cls, SUM(n) AS npred FROM conf GROUP BY prediction) p ON p.cls = t.cls),
per2 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0e0 ELSE 2 * precision * recall / (precision + recall) END
              AS f1_score
  FROM per)
SELECT CAST(cls AS VARCHAR) AS class_label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
       ROUND(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(SUM(tp) * 1.0e0 / SUM(support), 6), CAST(SUM(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', ROUND(AVG(precision), 6), ROUND(AVG(recall), 6), ROUND(AVG(f1_score), 6),
                 CAST(SUM(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', ROUND(SUM(precision * support) / SUM(support), 6),
                 ROUND(SUM(recall * support) / SUM(support), 6), ROUND(SUM(f1_score * support) / SUM(support), 6),
                 CAST(SUM(support) AS BIGINT) FROM per2"""))(knn_report)


def accuracy_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acc_by_group(_knn(spark, sf_dir), "level")


query("accuracy_by_group", O.with_fact(KNN_SQL + """
SELECT level, ROUND(AVG(CASE WHEN label = prediction THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy,
       COUNT(*) AS n_test
FROM pred GROUP BY level"""))(accuracy_by_group)


# ----------------------------------------------------------- clustering ----
def _points(spark, sf_dir):
    m = model.mart(spark, sf_dir)
    pts = m.where(~F.col("is_aggregate") & F.col("gap_total").isNotNull() & F.col("pct_sev").isNotNull())
    return standardize(pts.select("entity", "gap_total", "pct_sev", "inclusion_group"), ["gap_total", "pct_sev"])


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared-Euclidean silhouette of the mart's inclusion groups on the
    standardised (gap, severe value) features."""
    s = silhouette_sq(_points(spark, sf_dir), ["gap_total_z", "pct_sev_z"], "inclusion_group")
    return s.select(F.round("silhouette", 6).alias("silhouette"))


query("silhouette", O.with_mart("""
, pts AS (SELECT entity, inclusion_group AS c, gap_total, pct_sev FROM mart
          WHERE NOT is_aggregate AND gap_total IS NOT NULL AND pct_sev IS NOT NULL),
st AS (SELECT AVG(gap_total) AS m0, STDDEV_POP(gap_total) AS s0, AVG(pct_sev) AS m1, STDDEV_POP(pct_sev) AS s1 FROM pts),
z AS (SELECT entity, c, (gap_total - m0) / s0 AS x0, (pct_sev - m1) / s1 AS x1 FROM pts, st),
cs AS (SELECT c, COUNT(*) AS n, SUM(x0) AS s0, SUM(x1) AS s1, SUM(x0 * x0 + x1 * x1) AS q FROM z GROUP BY c),
dd AS (
  SELECT z.entity, z.c = cs.c AS is_own, cs.n,
         (z.x0 * z.x0 + z.x1 * z.x1) - 2.0e0 * (z.x0 * cs.s0 + z.x1 * cs.s1) / cs.n + cs.q / cs.n AS md
  FROM z CROSS JOIN cs),
ab AS (
  SELECT entity, MAX(CASE WHEN is_own THEN n END) AS n_own,
         MAX(CASE WHEN is_own AND n > 1 THEN md * n / (n - 1) END) AS a0,
         MIN(CASE WHEN NOT is_own THEN md END) AS b
  FROM dd GROUP BY entity),
s AS (
  SELECT CASE WHEN n_own <= 1 THEN 0.0e0
              WHEN COALESCE(a0, 0.0e0) < b THEN 1.0e0 - COALESCE(a0, 0.0e0) / b
              WHEN COALESCE(a0, 0.0e0) > b THEN b / COALESCE(a0, 0.0e0) - 1.0e0 ELSE 0.0e0 END AS s
  FROM ab)
SELECT ROUND(AVG(s), 6) AS silhouette FROM s"""))(silhouette)


def silhouette_euclid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the same with the Euclidean distance, which sums of squares can't give."""
    s = silhouette_euclid(_points(spark, sf_dir), ["gap_total_z", "pct_sev_z"], "inclusion_group", "entity")
    return s.select(F.round("silhouette", 6).alias("silhouette"))


query("silhouette_euclid", O.with_mart("""
, pts AS (SELECT entity, inclusion_group AS c, gap_total, pct_sev FROM mart
          WHERE NOT is_aggregate AND gap_total IS NOT NULL AND pct_sev IS NOT NULL),
st AS (SELECT AVG(gap_total) AS m0, STDDEV_POP(gap_total) AS s0, AVG(pct_sev) AS m1, STDDEV_POP(pct_sev) AS s1 FROM pts),
z AS (SELECT entity, c, (gap_total - m0) / s0 AS x0, (pct_sev - m1) / s1 AS x1 FROM pts, st),
far AS (SELECT a.entity, a.c AS own, b.c, SUM(sqrt((a.x0 - b.x0) ** 2 + (a.x1 - b.x1) ** 2)) AS d, COUNT(*) AS n FROM z a, z b GROUP BY ALL),
ab AS (SELECT entity, MAX(n) FILTER (own = c) AS size, MAX(d / greatest(n - 1, 1)) FILTER (own = c) AS a, MIN(d / n) FILTER (own <> c) AS b
       FROM far GROUP BY entity)
SELECT ROUND(AVG(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab"""))(silhouette_euclid_q)


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3/M6: K-Means k=3 (best of 10 seeds), clusters renumbered by mean gap."""
    return (_clusters(spark, sf_dir)
            .select("entity", "gap_total", "pct_sev", "cluster", "group_name")
            .orderBy(F.col("gap_total").desc(), "entity"))


query("kmeans_clusters", note="MLlib K-Means with seed restarts: rows-only")(kmeans_clusters)


def elbow(spark: SparkSession, sf_dir: str, ks=range(2, 7)) -> DataFrame:
    """M4/M5: best cost over restarts and silhouette for each k; as in the reference, a k
    of the number of points or more has no row."""
    pts = _points(spark, sf_dir).checkpoint()
    n = pts.count()
    if n <= min(ks):
        raise ValueError(f"{n} points are too few for any of the cluster numbers {list(ks)}")
    best, vec = kmeans_grid(pts, ["gap_total_z", "pct_sev_z"], [k for k in ks if k < n])
    rows = []
    for k, (m, cost) in sorted(best.items()):
        sil = silhouette_sq(m.transform(vec), ["gap_total_z", "pct_sev_z"], "cluster_raw").collect()[0][0]
        rows.append((k, float(cost), float(sil)))
    return spark.createDataFrame(rows, "k int, cost double, silhouette double")


query("elbow", note="MLlib K-Means per k: rows-only")(elbow)


# -------------------------------------------------------------- trees ----
def tree_forest_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = model._key(spark, sf_dir, "compare")
    if key not in model._CACHE:
        model._CACHE[key] = compare_models(_ml(spark, sf_dir), CODES)
    return model._CACHE[key]


query("tree_forest_compare", note="MLlib fits: rows-only")(tree_forest_compare)


def model_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_table(tree_forest_compare(spark, sf_dir))


query("model_results", note="MLlib fits: rows-only")(model_results)


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tree_forest_compare(spark, sf_dir).where("is_best").first()["model"]
    return importances(_ml(spark, sf_dir), CODES, FEATURE_NAMES, best)


query("feature_importance", note="MLlib fit: rows-only")(feature_importance)


def tree_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(_ml(spark, sf_dir), CODES, FEATURE_NAMES)


query("tree_rules", note="MLlib fit: rows-only")(tree_rules)


def profile_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(_ml(spark, sf_dir), CODES)


query("profile_scores", note="MLlib fit: rows-only")(profile_scores)

#: The profiles that the report names: focus entity by sex, age and level, and three others.
PROFILES = (("NATION_3", "GF_L_SEV"), ("NATION_3", "GO_L_NONE"), ("NATION_0", "L_SEV"), ("NATION_7", "BP_L_SEV"),
            ("NATION_12", "GF_L_LTD"))


def _scorer(spark, sf_dir):
    key = model._key(spark, sf_dir, "scorer")
    if key not in model._CACHE:
        ml = _ml(spark, sf_dir)
        model._CACHE[key] = fit_scorer(ml, ml.where(~F.col("is_test")), FEATURES)
    return model._CACHE[key]


def named_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles by their feature values; ``label`` is null where the sample lacks the cell."""
    named = spark.createDataFrame(list(PROFILES), "entity string, category_code string")
    axes = F.broadcast(model.dim_category(spark).select("category_code", "level", "ls", "os"))
    known = _ml(spark, sf_dir).select("entity", "category_code", "label")
    got = score_profiles(_scorer(spark, sf_dir), named.join(axes, "category_code", "left"))
    return (got.join(known, ["entity", "category_code"], "left")
            .select("entity", "category_code", "label", "prediction", "prob_pos"))


query("named_profiles", note="MLlib fit: rows-only")(named_profiles)


def _clusters(spark, sf_dir):
    key = model._key(spark, sf_dir, "kmeans")
    if key not in model._CACHE:
        pts = _points(spark, sf_dir)
        m, _, vec = kmeans_restarts(pts, ["gap_total_z", "pct_sev_z"], 3)
        model._CACHE[key] = relabel_by_mean(m.transform(vec), "gap_total").checkpoint()
    return model._CACHE[key]


def _grouped(spark, sf_dir):
    """The mart's inclusion groups in the place of clusters, numbered by mean gap."""
    return relabel_by_mean(_points(spark, sf_dir), "gap_total", raw="inclusion_group")


def _means(clusters: DataFrame) -> DataFrame:
    return (clusters.groupBy("cluster", "group_name")
            .agg(F.avg("gap_total").alias("mean_gap_total"), F.avg("pct_sev").alias("mean_pct_sev"),
                 F.count(F.lit(1)).alias("n_entities"))
            .orderBy("cluster"))


def _check(clusters: DataFrame, entities) -> DataFrame:
    c = clusters.where(F.col("entity").isin(*entities))
    return c.agg(F.count(F.lit(1)).alias("n_found"), F.count_distinct("cluster").alias("n_clusters"),
                 (F.count_distinct("cluster") == 1).alias("same_cluster"),
                 F.array_sort(F.collect_set("group_name")).alias("groups"))


GROUPED_SQL = """
, pts AS (SELECT entity, inclusion_group, gap_total, pct_sev FROM mart
          WHERE NOT is_aggregate AND gap_total + pct_sev IS NOT NULL),
numbered AS (SELECT inclusion_group, row_number() OVER (ORDER BY avg(gap_total), inclusion_group) - 1 AS cluster
             FROM pts GROUP BY inclusion_group),
grouped AS (SELECT *, ['High inclusion', 'Medium inclusion', 'Low inclusion'][cluster + 1] AS group_name
            FROM pts JOIN numbered USING (inclusion_group))"""


def group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 on a grouping that SQL can follow."""
    return _means(_grouped(spark, sf_dir))


query("group_means", O.with_mart(GROUPED_SQL + """
SELECT cluster, group_name, avg(gap_total) AS mean_gap_total, avg(pct_sev) AS mean_pct_sev, count(*) AS n_entities
FROM grouped GROUP BY ALL"""))(group_means)


def group_check(spark: SparkSession, sf_dir: str, entities=("NATION_3", "NATION_7")) -> DataFrame:
    """M7 on the same grouping."""
    return _check(_grouped(spark, sf_dir), entities).withColumn("groups", F.array_join("groups", ","))


query("group_check", O.with_mart(GROUPED_SQL + """
SELECT count(*) AS n_found, count(DISTINCT cluster) AS n_clusters, count(DISTINCT cluster) = 1 AS same_cluster,
       string_agg(DISTINCT group_name, ',' ORDER BY group_name) AS groups
FROM grouped WHERE entity IN ('NATION_3', 'NATION_7')"""))(group_check)


def cluster_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean features and size per (relabelled) cluster."""
    return _means(_clusters(spark, sf_dir))


query("cluster_means", note="depends on the K-Means fit: rows-only")(cluster_means)


def cluster_check(spark: SparkSession, sf_dir: str, entities=("NATION_3", "NATION_7")) -> DataFrame:
    """M7: do the named entities share one cluster?"""
    return _check(_clusters(spark, sf_dir), entities)


query("cluster_check", note="depends on the K-Means fit: rows-only")(cluster_check)


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class in the ML sample."""
    from ..ml.evaluate import class_balance as balance
    return balance(_ml(spark, sf_dir))


query("class_balance", O.with_fact(ML_SQL + """
SELECT label, COUNT(*) AS n FROM mls GROUP BY label"""))(class_balance)
