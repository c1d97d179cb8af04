"""Classification evaluation as DataFrame aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(pred: DataFrame, classes: Sequence[int] = (0, 1), label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """Counts for every (label, prediction) pair of ``classes`` (0 when
    a pair never occurs).  The pair grid is #classes^2 literal rows."""
    spark = pred.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes],
                                 f"{label} long, {prediction} long")
    counts = pred.groupBy(F.col(label).cast("long").alias(label),
                          F.col(prediction).cast("long").alias(prediction)).agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(grid).join(counts, [label, prediction], "left")
            .select(label, prediction, F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _safe(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def report(conf: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Precision / recall / f1 / support per class, then accuracy, macro
    and weighted averages (sklearn's layout; 0/0 gives 0)."""
    per = (conf.groupBy(F.col(label).alias("cls"))
           .agg(F.sum(F.when(F.col(label) == F.col(prediction), F.col("n"))).alias("tp"),
                F.sum("n").alias("support")))
    predicted = conf.groupBy(F.col(prediction).alias("cls")).agg(F.sum("n").alias("npred"))
    per = per.join(predicted, "cls")
    per = (per.withColumn("precision", _safe(F.col("tp").cast("double"), F.col("npred")))
           .withColumn("recall", _safe(F.col("tp").cast("double"), F.col("support")))
           .withColumn("f1_score", _safe(2 * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall"))))
    classes = per.select(F.col("cls").cast("string").alias("class_label"), "precision", "recall", "f1_score",
                         F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("tp").alias("tp"), F.sum("support").alias("n"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class_label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1_score"),
                 F.col("n").cast("long").alias("support")),
        *[F.struct(F.lit(name).alias("class_label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                   F.col(f).alias("f1_score"), F.col("n").cast("long").alias("support"))
          for name, p, r, f in (("macro avg", "mp", "mr", "mf"), ("weighted avg", "wp", "wr", "wf"))])))
    out = classes.unionByName(summary)
    return out.select("class_label", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")],
                      "support")


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def accuracy_by_group(pred: DataFrame, group: str, label: str = "label",
                      prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """A18."""
    return pred.groupBy(group).agg(
        F.round(F.avg((F.col(label) == F.col(prediction)).cast("double")), digits).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """A13."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def majority_baseline(df: DataFrame, label: str = "label", digits: int = 6) -> DataFrame:
    """Accuracy of always predicting the most frequent class."""
    return class_balance(df, label).agg(
        F.max("n").cast("long").alias("majority_n"), F.sum("n").cast("long").alias("total"),
        F.round(F.max("n") / F.sum("n"), digits).alias("majority_accuracy"))
