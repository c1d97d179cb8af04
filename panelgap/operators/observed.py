"""Metrics of a load from the load itself.

The reference logs counts of values that don't parse, flags and ranges while it cleans.  Here
an ``Observation`` rides on the write of the clean panel: the job that writes the rows
counts them, and no second scan is needed for the report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .clean import RAW_RENAME, clean_panel


def raw_metrics(value: str = "OBS_VALUE", flag: str = "OBS_FLAG", flags: Sequence[str] = ("u", " u ")) -> dict[str, Column]:
    """Of the raw rows: number, values that don't parse, rows by flag (null, the known ones, others)."""
    f = F.col(flag)
    known = {f"flag_{i}": F.count_if(f == v) for i, v in enumerate(flags)}
    return {"n_raw": F.count(F.lit(1)), "n_unparsed": F.count_if(F.col(value).try_cast("double").isNull()),
            "flag_none": F.count_if(f.isNull()), **known, "flag_other": F.count_if(f.isNotNull() & ~f.isin(*flags))}


def clean_metrics(value: str = "pct", low: float = 0.0, high: float = 100.0) -> dict[str, Column]:
    """Of the clean rows: number, reliable ones, values out of range, smallest and largest value."""
    v = F.col(value)
    return {"n_clean": F.count(F.lit(1)), "n_reliable": F.count_if(F.col("is_reliable")),
            "n_out_of_range": F.count_if(v.isNotNull() & ~v.between(low, high)), "min_value": F.min(v), "max_value": F.max(v)}


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    watch = Observation(name)
    return df.observe(watch, *[m.alias(k) for k, m in metrics.items()]), watch


def clean_and_measure(raw: DataFrame, entity_dim: DataFrame, codes: Sequence[str], path: str,
                      flags: Sequence[str] = ("u", " u ")) -> dict:
    """Writes the clean panel to ``path`` and returns the metrics of the raw and of the clean rows, all
    from that one job."""
    missing = [c for c in RAW_RENAME if c not in raw.columns]
    if missing:
        raise KeyError(f"required columns not found: {missing}")
    raw, before = observed(raw, "raw", raw_metrics(flags=flags))
    clean, after = observed(clean_panel(raw, entity_dim, codes, sort=False), "clean", clean_metrics())
    clean.write.mode("overwrite").parquet(path)
    return before.get | after.get
