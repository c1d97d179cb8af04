"""High-cardinality variants (FIXTURES B4): the same panel with customers or
suppliers as entities, exercising the distributed rank (W5) and the per-entity
top-k (O9) where the number of entities grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import cell_pivot
from ..operators.rank import rank_by, top_k_per_group
from . import model
from . import oracle as O
from .registry import query


def rank_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 == W1 on ~SF x 150k entities: RANK and ROW_NUMBER of the gap
    (reference level minus severe level) without a single-partition window."""
    cells = model.cells(spark, sf_dir, entity="customer", wanted_levels=("L_NONE", "L_SEV"), breakdowns=())
    piv = cell_pivot(cells, {"a": "L_NONE", "b": "L_SEV"}, reliable=None, require=("a", "b"))
    g = piv.select("entity", (F.col("a") - F.col("b")).alias("gap"))
    # one global sort by (gap desc, entity) yields both the ordinal and RANK
    return rank_by(g, "gap", tiebreak=["entity"], out="rank_gap", row_number_out="ordinal")


query("rank_distributed", O.with_cells("""
, p AS (
  SELECT entity, MAX(CASE WHEN category_code = 'L_NONE' THEN pct END) - MAX(CASE WHEN category_code = 'L_SEV' THEN pct END) AS gap,
         COUNT(CASE WHEN category_code = 'L_NONE' THEN 1 END) AS na, COUNT(CASE WHEN category_code = 'L_SEV' THEN 1 END) AS nb
  FROM cells WHERE category_code IN ('L_NONE', 'L_SEV') GROUP BY entity)
SELECT entity, gap, CAST(RANK() OVER (ORDER BY gap DESC NULLS LAST) AS BIGINT) AS rank_gap,
       CAST(ROW_NUMBER() OVER (ORDER BY gap DESC NULLS LAST, entity) AS BIGINT) AS ordinal
FROM p WHERE na > 0 AND nb > 0""", entity="customer"))(rank_distributed)


def topk_per_entity(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    """O9 per group: the k lowest cells of every supplier (RANK <= k)."""
    cells = model.cells(spark, sf_dir, entity="supplier")
    return top_k_per_group(cells.select("entity", "category_code", "pct"), "entity", k,
                           [F.col("pct").asc(), F.col("category_code").asc()])


query("topk_per_entity", O.with_cells("""
, r AS (SELECT entity, category_code, pct,
               CAST(RANK() OVER (PARTITION BY entity ORDER BY pct, category_code) AS BIGINT) AS rank
        FROM cells)
SELECT * FROM r WHERE rank <= 3""", entity="supplier"))(topk_per_entity)


def panel_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube maintained by Structured Streaming (counts by order of every micro-batch, joined to
    the orders when they are read); equals ``panel_build``."""
    from ..streaming.panel_stream import panel_from_stream
    return panel_from_stream(spark, sf_dir)


query("panel_stream", O.with_cells("SELECT * FROM cells"))(panel_stream)
