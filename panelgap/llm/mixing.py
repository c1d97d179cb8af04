"""Mixing sources to target weights by entropy balancing (operator 5).

Among all document rates that give every source its target number of words, the
ones nearest to 1 in entropy are tilted exponentially: a document of ``x`` words has
the rate ``min(cap, exp(lambda_s * x))`` with one dual variable per source.  Newton
steps on the convex dual find the variables; each step is one aggregation over
(source, size) counts, which is all that the rates depend on.  The rates are then
rounded into copies: per source, from the longest documents to the shortest, the
rounding error is carried on, so that it ends within the shortest size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .columns import column, free_name
from .quality import words

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
#: Documents of one source and size that one task ranks.
GROUP_ROWS = 512


def source_targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, cap: float = CAP) -> list[float]:
    """Words each source is to give, for (source, words) in the order given: shares of
    all words by the repeating weights, none above ``cap`` times its own words, the
    excess shared again by weight until none is above."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, free, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(n for _, n in sizes))
    while free:
        whole = sum(weight[i] for i in free)
        over = {i for i in free if rest * weight[i] / whole > cap * sizes[i][1]}
        if not over:
            for i in free:
                target[i] = rest * weight[i] / whole
            break
        for i in over:
            target[i] = cap * sizes[i][1]
        rest -= sum(target[i] for i in over)
        free -= over
    return target


def _solve(groups: DataFrame, sources: pd.DataFrame, cap: float, steps: int = 60) -> np.ndarray:
    """Dual variable of each source; infinite where only the cap reaches the target."""
    spark = groups.sparkSession
    whole, target = sources["words"].to_numpy(float), sources["target"].to_numpy(float)
    dual = np.where(target >= cap * whole, np.inf, 0.0)
    low, high = np.full(len(dual), -np.inf), np.full(len(dual), np.inf)
    todo = np.isfinite(dual) & (whole > 0)
    for _ in range(steps):
        if not todo.any():
            break
        now = spark.createDataFrame(pd.DataFrame({"s": np.flatnonzero(todo), "dual": dual[todo]}), "s int, dual double")
        tilt = F.exp(F.least(F.col("dual") * F.col("x"), F.lit(700.0)))
        part = groups.join(now, "s").select(
            "s", (F.col("n") * F.col("size") * F.least(tilt, F.lit(cap))).alias("g"),
            F.when(tilt < cap, F.col("n") * F.col("size") * F.col("x") * tilt).otherwise(0.0).alias("h"))
        for r in part.groupBy("s").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            s, miss = r["s"], r["g"] - target[r["s"]]
            if abs(miss) <= 1e-9 * max(1.0, target[s]):
                todo[s] = False
                continue
            low[s], high[s] = (dual[s], high[s]) if miss < 0 else (low[s], dual[s])
            reach = 1 + 2 * abs(dual[s])  # a step never more than triples the variable
            step = float(np.clip(-miss / r["h"], -reach, reach)) if r["h"] > 0 else math.copysign(reach, -miss)
            new = dual[s] + step
            if not low[s] < new < high[s]:
                new = (low[s] + high[s]) / 2
            todo[s] = new != dual[s]
            dual[s] = new
    return dual


def _round(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each (source, size) together, from long to short with the error carried on."""
    rows = rows.sort_values("size", ascending=False)
    carry, whole = 0.0, []
    for size, n, rate in zip(rows["size"], rows["n"], rows["rate"], strict=True):
        low = n * math.floor(rate)
        if size == 0:
            whole.append(n)
            continue
        k = int(min(max(round(n * rate + carry / size), low), n * math.ceil(rate)))
        carry += (n * rate - k) * size
        whole.append(k)
    return pd.DataFrame({"s": rows["s"], "size": rows["size"], "n": rows["n"], "whole": whole})


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, cap: float = CAP, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``carry`` columns, ``size`` (words), ``source_size``,
    ``target`` (of its source) and ``copies`` (0 up to the cap).

    Sources stand in code point order, null last, and take the weights in turn.  A null
    text has no words; texts without words are copied once, as they add nothing.  Which
    documents of a size get the extra copy follows from a hash of the id, so reruns
    agree.  The sources themselves (names and counts, not documents) pass the driver.
    Repeated rows are documents of their own; an empty table gives no rows; other columns
    are not read, whatever their names.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    spark, carry = docs.sparkSession, list(carry or [])
    base = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{source}`").alias("source"),
                       F.size(words(F.col(f"`{text}`"))).cast("long").alias("size"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).checkpoint()
    found = sorted(((r["source"], int(r["words"]), int(r["n"])) for r in base.groupBy("source").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()), key=lambda r: (r[0] is None, r[0] or ""))
    names = pd.DataFrame({"words": [r[1] for r in found], "n": [r[2] for r in found],
                          "target": source_targets([r[:2] for r in found], weights, cap)})
    sources = spark.createDataFrame(
        [(i, name, whole, float(t)) for i, ((name, whole, _), t) in enumerate(zip(found, names["target"], strict=True))],
        "s int, source string, source_size long, target double")
    keyed = (base.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
             .drop("source", "name"))
    mean = spark.createDataFrame([(i, max(1.0, r[1] / r[2])) for i, r in enumerate(found)], "s int, mean double")
    groups = (keyed.groupBy("s", "size").agg(F.count(F.lit(1)).alias("n")).join(mean, "s")
              .select("s", "size", "n", (F.col("size") / F.col("mean")).alias("x")).checkpoint())
    dual = _solve(groups, names, cap)
    solved = spark.createDataFrame([(i, float(x)) for i, x in enumerate(dual)], "s int, dual double")
    rate = F.when(F.col("dual") == float("inf"), F.lit(cap)).otherwise(
        F.least(F.exp(F.least(F.col("dual") * F.col("x"), F.lit(700.0))), F.lit(cap)))
    plan = (groups.join(solved, "s").withColumn("rate", rate).select("s", "size", "n", "rate")
            .groupBy("s").applyInPandas(_round, "s int, size long, n long, whole long"))
    # rank the documents of a source and size in parts of bounded size, by a hash of the id
    rank_in = Window.partitionBy("s", "size", "part").orderBy("h", "tie")
    before = Window.partitionBy("s", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (keyed.join(plan, ["s", "size"])
             .withColumn("h", F.xxhash64("doc", F.lit("copies")))
             .withColumn("part", F.pmod(F.xxhash64("doc", "h"), F.ceil(F.col("n") / GROUP_ROWS)))
             .withColumn("tie", F.xxhash64(*[f"c{i}" for i in range(len(carry))]) if carry else F.lit(0))
             .repartition("s", "size", "part"))  # else the join's partitioning, with a size in one task, would serve the window
    parts = (dealt.groupBy("s", "size", "part").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("ahead", F.coalesce(F.sum("m").over(before), F.lit(0))).drop("m"))
    place = F.col("ahead") + F.row_number().over(rank_in)
    copies = F.floor(F.col("whole") / F.col("n")) + (place <= F.col("whole") % F.col("n")).cast("int")
    return (dealt.join(parts, ["s", "size", "part"])
            .select(F.col("doc").alias(doc_id), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                    "size", "source_size", "target", copies.cast("int").alias("copies")))


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """``docs``, a stored table, with each row repeated as often as the mix takes it; columns as given,
    whatever their names (the inner ones take names that are free); an empty table stays empty."""
    row, times = free_name(docs, "row"), free_name(docs, "times")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    taken = mix(numbered, carry=[row], **parameters).where("copies > 0").select(row, F.col("copies").alias(times))
    return (numbered.join(taken, row).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
            .select(*[column(c) for c in docs.columns]))
