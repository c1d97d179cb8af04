"""Panel cleaning (P1-P11, A9): raw long-format strings -> typed, flagged,
decoded panel.  Every step is a column expression or a broadcast join against
a dimension, so the whole chain is one lazy plan (one scan, no UDF).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (AGE_PREFIX, AGE_VALUES, FLAG_UNRELIABLE, LEVELS, SEX_PREFIX, SEX_VALUES, TOTAL)
from ..functions.exprs import NA_TOKENS, strip
from .flags import reliable_expr

# raw column -> working name.  Fixed values: the raw file layout.
RAW_RENAME = {
    "TIME_PERIOD": "year",
    "geo": "entity",
    "Geopolitical entity (reporting)": "entity_label",
    "ind_type": "category_code",
    "Individual type": "category_desc",
    "OBS_VALUE": "pct",
    "OBS_FLAG": "quality_flag",
}
# columns present in the raw export but unused by the analysis
RAW_UNUSED = ["DATAFLOW", "LAST UPDATE", "freq", "Time frequency", "indic_is", "Indicator",
              "unit", "Unit of measure", "Time", "Observation value", "Observation status (Flag)",
              "CONF_STATUS", "Confidentiality status (flag)", "Geopolitical entity code"]

# prefix -> decoded value, for the test-data cube
SEX_PREFIXES = {f"{SEX_PREFIX}{v}_": v for v, *_ in SEX_VALUES[1:]}
AGE_PREFIXES = {f"{AGE_PREFIX}{v}_": v for v, *_ in AGE_VALUES[1:]}
LEVEL_LABELS = {c: lab for c, lab, *_ in LEVELS}
CLEAN_COLUMNS = ["year", "entity", "entity_name", "entity_label", "category_code", "level_label",
                 "ls", "os", "category_desc", "pct", "quality_flag", "is_reliable"]


def null_na_tokens(df: DataFrame, keep: Sequence[str] = (), tokens=NA_TOKENS) -> DataFrame:
    """Map the missing-value tokens a pandas reader would null to NULL,
    except in ``keep`` columns (codes such as 'NA' are data there)."""
    return df.select(*[
        F.when(F.col(f"`{c}`").isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
        if c not in keep else F.col(f"`{c}`")
        for c in df.columns])


def select_rename(df: DataFrame, mapping: Mapping[str, str] = RAW_RENAME) -> DataFrame:
    """Assert the required raw columns exist, keep and rename them."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise KeyError(f"required columns not found: {missing}")
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in mapping.items()])


def filter_entities(df: DataFrame, entity_dim: DataFrame, entity: str = "entity") -> DataFrame:
    """Keep target entities and attach their name in one inner join.  The
    caller decides on broadcasting (``F.broadcast(dim)`` when the dimension is
    known to be small); otherwise the optimizer and AQE choose."""
    return df.join(entity_dim.select(entity, "entity_name"), entity)


def filter_categories(df: DataFrame, codes: Sequence[str], category: str = "category_code") -> DataFrame:
    """Keep the listed category codes (IN-list, pushed to the scan)."""
    return df.where(F.col(category).isin(*codes))


def handle_flags(df: DataFrame, flag: str = "quality_flag", value: str = "pct",
                 trim: bool = True, unreliable: str = FLAG_UNRELIABLE) -> DataFrame:
    """Fill and strip the flag, derive ``is_reliable``, blank -> NULL."""
    f = F.coalesce(F.col(flag), F.lit(""))
    if trim:
        f = strip(f)
    df = df.withColumn(flag, f)
    df = df.withColumn("is_reliable", reliable_expr(flag, value, unreliable))
    return df.withColumn(flag, F.nullif(F.col(flag), F.lit("")))


def convert_types(df: DataFrame, year: str = "year", value: str = "pct") -> DataFrame:
    """Coercing casts (malformed -> NULL, never an error under ANSI)."""
    return (df.withColumn(year, F.col(year).try_cast("int"))
            .withColumn(value, F.col(value).try_cast("double")))


def _prefix_regex(prefixes: Mapping[str, str]) -> str:
    return "|".join(re.escape(p) for p in sorted(prefixes, key=len, reverse=True))


def decode_category(df: DataFrame, category: str = "category_code",
                    sex_prefixes: Mapping[str, str] = SEX_PREFIXES,
                    age_prefixes: Mapping[str, str] = AGE_PREFIXES,
                    level_labels: Mapping[str, str] = LEVEL_LABELS,
                    out=("level_label", "ls", "os"), total: str = TOTAL) -> DataFrame:
    """Optional sex prefix, then optional age prefix, the rest is the
    level, labelled through ``level_labels`` (unknown rest kept verbatim).
    Only the listed prefixes match; the sex prefix must come first."""
    pattern = f"^({_prefix_regex(sex_prefixes)})?({_prefix_regex(age_prefixes)})?(.*)$"
    c = F.col(category)
    sx, ag, rest = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))

    def lookup(m: Mapping[str, str], key: Column, default: Column) -> Column:
        mp = F.create_map(*[x for kv in m.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        return F.coalesce(mp[key], default)

    return (df.withColumn(out[0], lookup(level_labels, rest, rest))
            .withColumn(out[1], lookup(sex_prefixes, sx, F.lit(total)))
            .withColumn(out[2], lookup(age_prefixes, ag, F.lit(total))))


def reorder_sort(df: DataFrame, cols: Sequence[str] = CLEAN_COLUMNS,
                 keys: Sequence[str] = ("entity", "level_label", "ls", "os")) -> DataFrame:
    """Final projection and order (a distributed range sort)."""
    return df.select(*cols).orderBy(*keys)


def clean_panel(raw: DataFrame, entity_dim: DataFrame, codes: Sequence[str],
                legacy_order: bool = False, trim: bool = True, sort: bool = True) -> DataFrame:
    """The cleaning chain.  ``legacy_order=True`` flags reliability before the
    numeric coercion (the reference's order: a malformed value becomes NULL
    yet stays reliable); the default coerces first.  Without ``sort`` the rows stay where
    they are, for consumers that don't need their order or write them clustered."""
    df = select_rename(raw)
    df = filter_entities(df, entity_dim)
    df = filter_categories(df, codes)
    if legacy_order:
        df = convert_types(handle_flags(df, trim=trim))
    else:
        df = handle_flags(convert_types(df), trim=trim)
    df = decode_category(df)
    return reorder_sort(df) if sort else df.select(*CLEAN_COLUMNS)


def load_and_clean(raw: DataFrame, entity_names: DataFrame,
                   level_labels: Mapping[str, str] = LEVEL_LABELS) -> DataFrame:
    """The alternate preset.  No entity or category filter, flags not stripped (so
    ``' u '`` stays reliable), reliability before the numeric coercion, labels of the
    caller, no order.  An entity without a name in ``entity_names`` keeps its rows
    with a null name."""
    df = convert_types(handle_flags(select_rename(raw), trim=False))
    df = decode_category(df, level_labels=level_labels)
    return df.join(entity_names.select("entity", "entity_name"), "entity", "left").select(*CLEAN_COLUMNS)


def profile_raw(raw: DataFrame, value: str = "OBS_VALUE", flag: str = "OBS_FLAG",
                entity: str = "geo") -> tuple[DataFrame, DataFrame]:
    """(one-row profile: values that do not parse, distinct entities
    sorted), (flag histogram with NULL as its own group).  The entity list is
    one array, so use it on a bounded entity axis (nations); for an unbounded
    one use ``distinct_sorted``, which stays distributed."""
    prof = raw.agg(F.count_if(F.col(value).try_cast("double").isNull()).alias("n_unparsed"),
                   F.array_sort(F.collect_set(entity)).alias("entities"))
    hist = raw.groupBy(F.col(flag).alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    return prof, hist


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """A10 at any cardinality: the distinct values as a range-sorted DataFrame."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def range_report(df: DataFrame, value: str = "pct", low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Count of present values outside [low, high], plus min and max."""
    v = F.col(value)
    return df.agg(F.count_if(v.isNotNull() & ~v.between(low, high)).alias("n_out_of_range"),
                  F.min(v).alias("min_value"), F.max(v).alias("max_value"))


def raw_from_fact(fact: DataFrame, entity_dim: DataFrame, dim_level: DataFrame, dim_sex: DataFrame,
                  dim_age: DataFrame, year: str = "1998") -> DataFrame:
    """The panel written back in the raw long layout (all strings): what an
    export of the fact looks like before cleaning.  Flags alternate between
    'u' and ' u ' (padded on total-sex cells) to exercise the strip rule."""
    # level/sex/age are the cube's axes (a handful of codes each); the entity
    # dimension is broadcast only if the caller hinted it
    f = (fact.join(entity_dim.select("entity", "entity_name"), "entity")
         .join(F.broadcast(dim_level.select("level", "level_label")), "level")
         .join(F.broadcast(dim_sex.select("ls", "ls_label")), "ls")
         .join(F.broadcast(dim_age.select("os", "os_label")), "os"))
    desc = F.concat_ws(" - ", F.when(F.col("ls") != TOTAL, F.col("ls_label")),
                       F.when(F.col("os") != TOTAL, F.col("os_label")), F.col("level_label"))
    flag = F.when(F.col("quality_flag").isNull(), F.lit(None).cast("string")) \
            .when(F.col("ls") == TOTAL, F.lit(f" {FLAG_UNRELIABLE} ")).otherwise(F.lit(FLAG_UNRELIABLE))
    cols = {
        "DATAFLOW": F.lit("PANEL:CELLS(1.0)"), "LAST UPDATE": F.lit("1998-12-31"),
        "freq": F.lit("A"), "Time frequency": F.lit("Annual"), "indic_is": F.lit("Q20"),
        "Indicator": F.lit("Share of lines with quantity above 20"),
        "unit": F.lit("PC"), "Unit of measure": F.lit("Percentage"),
        "geo": F.col("entity"), "Geopolitical entity code": F.col("entity"),
        "Geopolitical entity (reporting)": F.col("entity_name"),
        "ind_type": F.col("category_code"), "Individual type": desc,
        "TIME_PERIOD": F.lit(year), "Time": F.lit(year),
        "OBS_VALUE": F.col("pct").cast("string"), "Observation value": F.col("pct").cast("string"),
        "OBS_FLAG": flag, "Observation status (Flag)": flag,
        "CONF_STATUS": F.lit(None).cast("string"), "Confidentiality status (flag)": F.lit(None).cast("string"),
    }
    return f.select(*[e.alias(k) for k, e in cols.items()])
