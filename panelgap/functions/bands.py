"""Banding CASE expressions.

One operator covers the four CASE shapes of the reference: ordered thresholds,
strict or inclusive comparison, ascending (``<``) or descending (``>``) scan,
an ELSE label, optional guards evaluated first, and what a NULL input gives.
SQL semantics: a NULL comparison is not true, so NULL falls through to ELSE
unless ``null_label`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col


def band(c, thresholds: Sequence[tuple[float, str]], else_label: str | None,
         op: str = "<", guards: Sequence[tuple[Column, str | None]] = (),
         null_label: str | None = "__else__") -> Column:
    """``CASE [guards] WHEN c op t1 THEN l1 WHEN c op t2 THEN l2 ... ELSE else END``.

    ``null_label='__else__'`` (default) keeps SQL fall-through; ``None`` makes
    a NULL input give NULL (the mart's Python rule)."""
    ops = {"<": lambda x, t: x < t, "<=": lambda x, t: x <= t,
           ">": lambda x, t: x > t, ">=": lambda x, t: x >= t}
    cmp = ops[op]
    x = col(c)
    e = None
    for cond, lab in guards:
        v = F.lit(lab).cast("string")
        e = F.when(cond, v) if e is None else e.when(cond, v)
    if null_label != "__else__":
        v = F.lit(null_label).cast("string")
        e = F.when(x.isNull(), v) if e is None else e.when(x.isNull(), v)
    for t, lab in thresholds:
        e = F.when(cmp(x, F.lit(t)), F.lit(lab)) if e is None else e.when(cmp(x, F.lit(t)), F.lit(lab))
    return e.otherwise(F.lit(else_label).cast("string"))


def band_between(c, low: float, high: float, low_label: str, high_label: str, mid_label: str,
                 guards: Sequence[tuple[Column, str | None]] = ()) -> Column:
    """Two-sided band ``< low`` / ``> high`` / else (C11, the mart rule);
    NULL input gives NULL."""
    x = col(c)
    e = None
    for cond, lab in guards:
        v = F.lit(lab).cast("string")
        e = F.when(cond, v) if e is None else e.when(cond, v)
    nul = F.lit(None).cast("string")
    e = F.when(x.isNull(), nul) if e is None else e.when(x.isNull(), nul)
    return e.when(x < F.lit(low), F.lit(low_label)).when(x > F.lit(high), F.lit(high_label)) \
            .otherwise(F.lit(mid_label))
