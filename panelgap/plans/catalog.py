"""Collects every registered query (importing the modules registers them)."""

from __future__ import annotations

from . import queries as _q  # noqa: F401
from . import reports as _r  # noqa: F401
from . import pipeline as _p  # noqa: F401
from . import scale as _s  # noqa: F401
from . import dirty as _d  # noqa: F401
from . import ml_queries as _m  # noqa: F401
from . import views as _v  # noqa: F401
from . import sql_surface as _sql  # noqa: F401
from . import constraint_queries as _c  # noqa: F401
from . import load_queries as _l  # noqa: F401
from . import fine_queries as _f  # noqa: F401
from .registry import REGISTRY


def queries():
    return {n: q.build for n, q in REGISTRY.items()}


def oracle_sql():
    return {n: q.oracle for n, q in REGISTRY.items() if q.oracle is not None}
