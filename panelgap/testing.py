"""Compare a Spark query with its DuckDB oracle (used by tests and scripts)."""

from __future__ import annotations

import math
import os

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int = 6):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, digits) + 0.0)
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


def normalize(columns, rows, digits: int = 6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i], digits) for i in order) for r in rows)
    return cols, out


def compare(spark_df, con, sql: str, digits: int = 6):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sc, sr = normalize(s_cols, s_rows, digits)
    dc, dr = normalize(d_cols, d_rows, digits)
    if sc != dc:
        return False, f"columns differ: spark={sc} oracle={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} oracle={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(sr)} rows equal"
