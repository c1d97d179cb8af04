"""Star schema (S5-S9, J1): dimensions, fact and mart.

Dimensions are either literal rows (level, sex, age, category: a handful of
fixed codes) or derived from fixed-size TPC-H tables (entity: nation x region),
so they are broadcast.  The fact is the flagged panel; it is built once per
session and source folder and checkpointed, as the reference loads its fact
once and then runs every query against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..config import AGE_VALUES, INDICATOR, LEVELS, NULL_CATEGORY, SEX_VALUES, all_category_codes, DEFAULT_SPEC, PanelSpec
from ..operators.derive import derive_gaps
from ..operators.flags import flag_small_cells
from ..operators.metrics import entity_metrics
from ..operators.panel import build_panel
from ..session import ensure_checkpoint_dir
from ..sources.tables import entity_dim, input_listing, panel_microdata

_CACHE: dict = {}


def dim_level(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(c, lab, s, bool(a)) for c, lab, s, a in LEVELS],
        "level string, level_label string, level_order int, level_is_aggregate boolean")


def dim_sex(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEX_VALUES, "ls string, ls_label string, ls_order int")


def dim_age(spark: SparkSession) -> DataFrame:
    """The age axis is a status code here, so its bounds are null; a value of the category with
    known issues has them too."""
    issues = {age for code, _, _, age in all_category_codes() if code == NULL_CATEGORY}
    return spark.createDataFrame([(c, lab, k, None, None, c in issues) for c, lab, k in AGE_VALUES],
                                 "os string, os_label string, os_order int, age_min int, age_max int, has_data_issues boolean")


def dim_category(spark: SparkSession) -> DataFrame:
    rows = [(code, lvl, sx, ag, sx == "Total" and ag == "Total", code == NULL_CATEGORY)
            for code, lvl, sx, ag in all_category_codes()]
    return spark.createDataFrame(rows, "category_code string, level string, ls string, os string, is_core boolean, "
                                       "has_known_data_issues boolean")


def dim_indicator(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([INDICATOR], "indicator string, indicator_name string, unit string, frequency string, "
                                              "reference_year int")


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it is loaded, with the key of its indicator."""
    return fact(spark, sf_dir)


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (spark.sparkContext.applicationId, sf_dir, input_listing(spark, sf_dir), what)


def cells(spark: SparkSession, sf_dir: str, entity: str = "nation",
          spec: PanelSpec = DEFAULT_SPEC, **wanted) -> DataFrame:
    """Unflagged panel cells straight from the microdata (no caching); ``wanted`` limits
    the cube (``wanted_levels``, ``breakdowns``)."""
    return build_panel(panel_microdata(spark, sf_dir, entity, spec.hit_threshold), **wanted)


def fact(spark: SparkSession, sf_dir: str, entity: str = "nation",
         spec: PanelSpec = DEFAULT_SPEC, cache: bool = True) -> DataFrame:
    """The flagged panel with its derived columns = fact table.  Checkpointed
    once per session to the shared checkpoint folder, so the queries of a
    session share one build, plan against a plain scan, and a lost executor
    costs nothing to recompute."""
    key = _key(spark, sf_dir, f"fact:{entity}:{spec!r}")
    if cache and key in _CACHE:
        return _CACHE[key]
    ensure_checkpoint_dir(spark)
    base = cells(spark, sf_dir, entity, spec)
    # the indicator's key is written with the fact: as a literal it would fold the join on it into a
    # constant, and the join into a nested loop
    df = derive_gaps(flag_small_cells(base, spec.suppress_below, spec.flag_below),
                     ref_level=spec.ref_level, bench_entity=spec.aggregate_entity).withColumn("indicator", F.lit(INDICATOR[0]))
    if cache:
        # a checkpoint rather than a cache: queries then plan against a plain
        # scan instead of matching the whole flag/derive lineage every time
        df = df.checkpoint(eager=True)
        _CACHE[key] = df
    return df


def mart(spark: SparkSession, sf_dir: str, spec: PanelSpec = DEFAULT_SPEC,
         cache: bool = True) -> DataFrame:
    key = _key(spark, sf_dir, f"mart:{spec!r}")
    if cache and key in _CACHE:
        return _CACHE[key]
    df = entity_metrics(fact(spark, sf_dir, spec=spec, cache=cache), spec)
    if cache:
        ensure_checkpoint_dir(spark)
        df = df.checkpoint(eager=True)
        _CACHE[key] = df
    return df


def entities(spark: SparkSession, sf_dir: str, cache: bool = True) -> DataFrame:
    """dim_entity (nation x region + aggregate row), cached per session."""
    key = _key(spark, sf_dir, "dim_entity")
    if cache and key in _CACHE:
        return _CACHE[key]
    df = entity_dim(spark, sf_dir)
    if cache:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        _CACHE[key] = df
    return df


def clear_cache() -> None:
    for kept in _CACHE.values():
        if isinstance(kept, DataFrame):
            kept.unpersist()
    _CACHE.clear()


def ml_frame(spark: SparkSession, sf_dir: str, cache: bool = True) -> DataFrame:
    """Labelled, encoded, fold-assigned ML sample (checkpointed once per session)."""
    from ..ml.sample import ml_frame as build
    key = _key(spark, sf_dir, "ml")
    if cache and key in _CACHE:
        return _CACHE[key]
    df = build(fact(spark, sf_dir, cache=cache))
    if cache:
        # checkpoint, not persist: the MLlib fits that read this frame run many
        # jobs each, and every job would re-plan the encoding joins and the
        # quantile subquery of its lineage
        ensure_checkpoint_dir(spark)
        df = df.checkpoint(eager=True)
        _CACHE[key] = df
    return df
