"""URL filter by a path-template tree (operator 8).

Per host, the paths form a tree of segments.  Variable segments become wildcards
(numbers and hex ids by their form, others where a node has many children seen about
once), and sibling branches that are statistically alike are merged.  The labelled
branches of a node form at most two clusters, mostly blocked and mostly allowed; a branch
belongs to one if its label rate doesn't differ significantly from the cluster's and if a
chi-square test doesn't tell the shapes beneath it, the forms of the paths and how often
they occur, from those of the cluster.  An unlabelled branch joins the cluster whose shapes
it has; where it has those of both, the one with more names that begin like its own, then
the nearer one, and none if they are equal.  A template is rejected by
the smoothed share of blocked urls among its labelled ones; the estimate of a host
shrinks towards the same template on all hosts, that towards the whole table.
Explicit rules come first.  All steps work on counts by (host, template).

Every segment is told apart, however deep.  A round generalises one branching of each
node: what all paths of a node share is skipped, and a node whose paths are equal is
finished, so there are as many rounds as branchings on one path, not as segments.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MANY_CHILDREN, Z, PRIOR_WEIGHT, REJECT_AT = 20, 1.96, 5.0, 0.7
#: Characters of a name that make it begin like another.
STEM = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits the host or a parent domain of it and begins the path."""
    which = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        which, verdict = F.when(fits, r.text).otherwise(which), F.when(fits, r.verdict).otherwise(verdict)
    return which, verdict


def raw_template(path: Column) -> Column:
    """Segments of a path with numbers and hex ids generalised."""
    parts = F.transform(F.split(path, "/"), lambda s: F.when(s.rlike("^[0-9a-f]{12,}$"), F.lit("<hex>"))
                        .otherwise(F.regexp_replace(s, "[0-9]+", "<n>")))
    return F.slice(parts, 2, F.size(parts))


def _head(n: Column) -> Column:
    return F.slice("seg", F.lit(1), n)


def _tail(n: Column) -> Column:
    """What follows the first ``n`` segments."""
    return F.slice("seg", n + 1, F.size("seg"))


def _next_branching(tree: DataFrame) -> DataFrame:
    """Moves ``at``, the segments already generalised, past those that all templates of a
    node share; null where there is nothing left to tell apart."""
    at, up = F.col("at"), _head(F.col("at")).alias("up")
    # the segments that the least and the greatest share, all share
    step = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), False)
    node = (tree.groupBy("host", up).agg(F.min(_tail(at)).alias("lo"), F.max(_tail(at)).alias("hi"))
            .select("host", "up", F.when(step > 0, (step - 1).cast("int")).alias("step")))
    return (tree.withColumn("up", _head(at)).join(node, ["host", "up"]).withColumn("at", at + F.col("step"))
            .drop("up", "step"))


def _form(tail: Column) -> Column:
    """What a path looks like: numbers, hex ids and names, whatever they are, and the marks between."""
    def form(s: Column) -> Column:
        s = F.regexp_replace(F.regexp_replace(s, "<hex>", "1"), "<n>", "0")
        return F.regexp_replace(s, "[^01._~-]+", "w")

    return F.array_join(F.transform(tail, form), "/")


def _clusters(forms: DataFrame, child: DataFrame) -> DataFrame:
    """(host, up, own, side) of the branches that are alike: ``forms`` has the rows of each branch by the form
    of what is beneath it, ``child`` its sums.  ``side`` is true for the blocked cluster."""
    node = ["host", "up"]
    blocked = F.col("blk") * 2 >= F.col("lab")
    named = child.where("own <> ''").withColumn("stem", F.substring("own", 1, STEM))
    known = named.where("lab > 0").withColumn("side", blocked)
    pool = known.groupBy(*node, "side").agg((F.sum("blk") / F.sum("lab")).alias("rate"), F.sum("n").alias("rows"))
    stems = known.groupBy(*node, "side", "stem").agg(F.count(F.lit(1)).alias("alike"))
    pool_forms = (forms.join(known.select(*node, "own", "side"), [*node, "own"])
                  .groupBy(*node, "side", "form").agg(F.sum("n").alias("seen")))
    kinds = forms.groupBy(*node).agg(F.count_distinct("form").alias("kinds"))
    spread = Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.col("lab"))
    may = (F.col("lab") == 0) | ((blocked == F.col("side")) & (F.abs(F.col("blk") / F.col("lab") - F.col("rate")) <= spread))
    candidate = (named.join(pool, node).where(may).select(*node, "own", "stem", "side", F.col("n").alias("whole"), "rows"))
    # chi-square of the branch's forms against the cluster's shares, half a row added to each form of the node
    expected = F.col("whole") * (F.coalesce("seen", F.lit(0)) + 0.5) / (F.col("rows") + 0.5 * F.col("kinds"))
    limit = F.greatest(F.col("kinds") - 1, F.lit(1))
    fits = (candidate.join(forms.select(*node, "own", "form", "n"), [*node, "own"]).join(kinds, node)
            .join(pool_forms, [*node, "side", "form"], "left")
            .groupBy(*node, "own", "stem", "side", "whole", "kinds").agg(F.sum(F.col("n") * F.col("n") / expected).alias("s"))
            .withColumn("far", F.round(F.col("s") - F.col("whole"), 6))
            .where(F.col("far") <= limit + Z * F.sqrt(2.0 * limit)))
    score = F.struct(F.coalesce("alike", F.lit(0)).alias("alike"), (-F.col("far")).alias("near"))
    best = (fits.join(stems, [*node, "side", "stem"], "left").groupBy(*node, "own")
            .agg(F.max(F.when(F.col("side"), score)).alias("b"), F.max(F.when(~F.col("side"), score)).alias("a")))
    chosen = (best.withColumn("side", F.when(F.col("a").isNull() | (F.col("b") > F.col("a")), True)
                              .when(F.col("b").isNull() | (F.col("a") > F.col("b")), False))
              .where("side is not null").select(*node, "own", "side"))
    kin = chosen.groupBy(*node, "side").agg(F.count(F.lit(1)).alias("kin")).where("kin > 1")
    return chosen.join(kin, [*node, "side"]).select(*node, "own", "side")


def _level(tree: DataFrame) -> DataFrame:
    """Generalises segment ``at`` of all templates: a wildcard under nodes with many rare
    children, and one branch for siblings that are alike."""
    at, node = F.col("at"), ["host", "up"]
    placed = tree.withColumn("up", _head(at)).withColumn("own", F.coalesce(F.get("seg", at), F.lit("")))
    sums = [F.sum(c).alias(c) for c in ("n", "lab", "blk")]
    forms = placed.groupBy(*node, "own", _form(_tail(at + 1)).alias("form")).agg(*sums).checkpoint()
    child = forms.groupBy(*node, "own").agg(*sums)
    wild = (child.groupBy(*node).agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("rows"))
            .where((F.col("children") > MANY_CHILDREN) & (F.col("children") * 2 > F.col("rows"))).select(*node, F.lit(True).alias("wild")))
    named = (child.select(*node, "own").join(wild, node, "left").join(_clusters(forms, child), [*node, "own"], "left")
             .select(*node, "own", F.when(F.col("own") == "", "").when(F.col("wild"), "*")
                     .when(F.col("side"), "*block").when(~F.col("side"), "*allow").otherwise(F.col("own")).alias("now")))
    return (placed.join(named, [*node, "own"])
            .withColumn("seg", F.when(F.size("seg") > at, F.concat("up", F.array("now"), _tail(at + 1)))
                        .otherwise(F.col("seg"))).withColumn("at", at + 1).drop("up", "own", "now"))


def template_verdicts(labelled: DataFrame) -> DataFrame:
    """``labelled(host, raw, label)``, label ``block``, ``allow`` or null, ->
    ``(host, raw, template, purity)`` for each distinct (host, raw)."""
    ensure_checkpoint_dir(labelled.sparkSession)
    tree = labelled.groupBy("host", "raw").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("lab"), F.count_if(F.col("label") == "block").alias("blk")
    ).withColumn("seg", F.col("raw")).withColumn("at", F.lit(0)).checkpoint()
    done = []
    while True:
        tree = _next_branching(tree).checkpoint()
        done.append(tree.where("at is null"))
        if tree.where("at is not null").isEmpty():
            break
        tree = _level(tree.where("at is not null")).checkpoint()
    tree = reduce(DataFrame.unionByName, done).withColumn("template", F.array_join("seg", "/"))
    overall = tree.agg((F.sum("blk") / F.greatest(F.sum("lab"), F.lit(1))).alias("p0")).scalar()
    own = tree.groupBy("host", "template").agg(F.sum("lab").alias("lab_h"), F.sum("blk").alias("blk_h"))
    # across hosts, templates are compared by form: merged branches have names of their own there too
    every = (tree.groupBy("template").agg(F.sum("lab").alias("lab_t"), F.sum("blk").alias("blk_t"))
             .select("template", ((F.col("blk_t") + PRIOR_WEIGHT * overall) / (F.col("lab_t") + PRIOR_WEIGHT)).alias("p_t")))
    purity = ((F.col("blk_h") + PRIOR_WEIGHT * F.col("p_t")) / (F.col("lab_h") + PRIOR_WEIGHT)).alias("purity")
    return (tree.join(own, ["host", "template"]).join(every, "template")
            .select("host", "raw", "template", purity))


def filter_urls(pages: DataFrame, rules: list[UrlRule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (the longest that fits, or null), ``template``,
    ``purity`` and ``verdict``: the rule's, else ``block`` where the template's smoothed
    share of blocked urls reaches ``REJECT_AT``, else ``allow``.

    The urls that a rule decides are the labelled ones.  A null url, or one without
    ``://``, has an empty host and path, fits no rule and is judged by its template
    like any other.  Repeated rows count as often as they occur; an empty table gives no rows;
    other columns are not read, whatever their names.
    """
    u = F.col("url_")
    base = (pages.select(F.col(f"`{page_id}`").alias("id_"), F.col(f"`{url}`").alias("url_"))
            .select("id_", host_of(u).alias("host"), path_of(u).alias("path")))
    which, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = base.withColumn("rule", which).withColumn("label", verdict).withColumn("raw", raw_template(F.col("path")))
    judged = template_verdicts(known.select("host", "raw", "label"))
    return (known.join(judged, ["host", "raw"])
            .select(F.col("id_").alias(page_id), "host", "path", "rule", "template", "purity",
                    F.coalesce("label", F.when(F.col("purity") >= REJECT_AT, "block").otherwise("allow")).alias("verdict")))
