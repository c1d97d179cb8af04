"""Sharding on a consistent-hash ring with virtual nodes and bounded loads (operator 2).

The ring is cut into ``CELLS`` cells; virtual nodes stand on cell borders.  A key
belongs to the next virtual node clockwise.  A shard takes keys up to its load
bound; what overflows continues clockwise to the next shard with room.  As all keys
of an arc walk the same way, the walk is worked out from the number of keys in each
cell (a fixed number of counts), and a key's shard follows from its rank in its
cell.  With no slack every shard ends within one key of the mean.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .columns import column, compared, hashable

CELL_BITS = 16
CELLS = 1 << CELL_BITS
VIRTUAL_NODES = 128
#: A cell with more rows than this and than a ``CROWD``-th of all is ranked in ``PARTS`` parts.
CROWDED_ROWS, CROWD, PARTS = 10_000, 1024, 64


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise.  A node serves the cells before its own."""
    at = {}
    for s in range(shards):
        for v in range(virtual_nodes):
            at.setdefault(xxhash.xxh64_intdigest(f"{s}/{v}") >> (64 - CELL_BITS), s)
    return sorted(at.items())


def load_bounds(total: int, shards: int, slack: float) -> list[int]:
    """Most keys a shard may hold; without slack they sum up to ``total``."""
    if slack <= 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [-int(-(1 + slack) * total // shards)] * shards


def place_cells(counts: dict[int, int], shards: int, slack: float = 0.0,
                virtual_nodes: int = VIRTUAL_NODES, parts: int = 1) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first) that cover the keys of all
    cells.  Each shard serves the arcs before its nodes in ring order, then what
    overflows to it, round by round.  With ``parts``, a cell's parts have the numbers from
    ``cell * parts`` on."""
    nodes = ring(shards, virtual_nodes)
    room = load_bounds(sum(counts.values()), shards, slack)
    load, out = [0] * shards, []
    waiting, node = [], 0
    for cell in sorted(counts):
        while node < len(nodes) and nodes[node][0] <= cell // parts:
            node += 1
        waiting.append((cell, 0, counts[cell], node % len(nodes)))
    while waiting:
        over = []
        for cell, lo, hi, node in waiting:
            shard = nodes[node][1]
            end = min(hi, lo + room[shard] - load[shard])
            if end > lo:
                out.append((cell, lo, end, shard, load[shard]))
                load[shard] += end - lo
            if end < hi:
                over.append((cell, max(lo, end), hi, (node + 1) % len(nodes)))
        waiting = over
    return out


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", slack: float = 0.0) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... without gaps in each shard).

    The id alone places a key on the ring; rows with equal ids are neighbours there, in
    the order of a hash of all columns that can be hashed (maps can't).  A row without an id is
    placed by that hash, so many of them spread over the ring.  An empty table stays empty.
    Columns named ``shard`` or ``slot``, compared as the session compares names, are replaced; all
    others, whatever their names, travel as one struct and come back as they were.

    A crowded cell, such as that of an id that a third of all rows have, is ranked in parts by a
    hash of the row and its place in the input, so no task sorts the whole of it.
    """
    name = compared(docs)
    keep = [c for c in docs.columns if name(c) not in ("shard", "slot")]
    row = F.struct(*[column(c).alias(c) for c in keep]) if keep else F.struct(F.lit(None).alias("none"))
    known = [column(c) for c in keep if hashable(docs.schema[c].dataType)]
    tie, key = F.xxhash64(*known) if known else F.lit(0).cast("long"), column(doc_id)
    at = F.when(key.isNull(), tie).otherwise(F.xxhash64(key))
    # the columns of the row are all inside one: the names below can't clash
    src = docs.select(row.alias("row"), at.alias("at"), tie.alias("tie"))
    cell = F.shiftrightunsigned("at", 64 - CELL_BITS).cast("int")
    counts = {r["cell"]: r["n"] for r in src.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = max(CROWDED_ROWS, sum(counts.values()) // CROWD)
    crowded = {c for c, n in counts.items() if n > limit}
    part = F.lit(0)
    if crowded:  # fewer than CROWD cells
        part = F.when(cell.isin(sorted(crowded)), F.pmod(F.xxhash64("tie", F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")).otherwise(0)
    ranked = src.withColumn("cell", cell * PARTS + part)
    parts = {c * PARTS: n for c, n in counts.items() if c not in crowded}
    if crowded:
        split = ranked.where(cell.isin(sorted(crowded))).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        parts |= {r["cell"]: r["n"] for r in split.collect()}
    # at most a row for each cell and part and for each place where a shard became full: a fixed bound
    plan = F.broadcast(docs.sparkSession.createDataFrame(
        place_cells(parts, shards, slack, parts=PARTS), "cell int, lo long, hi long, shard int, first long"))
    same = Window.partitionBy("cell").orderBy("at", "tie")
    ranked = ranked.withColumn("rank", (F.row_number().over(same) - 1).cast("long"))
    return (ranked.join(plan, "cell").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select(*[F.col("row").getField(c).alias(c) for c in keep],
                    "shard", (F.col("first") + F.col("rank") - F.col("lo")).alias("slot")))
