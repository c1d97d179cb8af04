"""Merkle manifest of a dataset with octopus multiproofs (operator 13).

Every row is a leaf; the leaves of a source form a tree of runs of three, and the roots of
all sources, in order, form one more such tree on top.  A node is named by its coordinates
(tree, level, place); the tree on top has the number ``TOP``.

The leaves are ordered by a distributed sort and dealt out in *units* of neighbouring
leaves: ``3**LEVELS`` aligned leaves of a large source, or a series of small sources.  A unit
works out, from the interval it covers, the smallest set of nodes that it lacks for the
proofs of all its leaves, fetches these once, derives all other nodes from its own leaves,
and expands the proof of each leaf locally.  Only nodes from the units' own tops upwards are
stored, about a node for every 500 leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ARITY = 3
#: Levels of a tree that one unit covers, and its leaves of one source at most.
LEVELS = 6
#: The tree of the sources' roots.
TOP = -1
#: Leaves whose proofs leave a task in one batch.
EMIT = 2048

_NODE = "tree long, level int, place long, size long, hash string"


def leaf_hash(*fields: Column) -> Column:
    """sha256 of the fields: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def parent(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    h = 0
    while size > 1:
        size, h = -(-size // ARITY), h + 1
    return h


def width(size: int, level: int) -> int:
    """Nodes of a level of a tree with ``size`` leaves."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def missing(lo: int, hi: int, size: int, level: int = 0) -> list[tuple[int, int]]:
    """Coordinates (level, place) of the nodes that a holder of places lo..hi of ``level`` lacks for
    the proofs of all of them: at each level the rest of the runs that the interval begins and ends
    in.  All other siblings are its own nodes or derived from them."""
    out, n = [], width(size, level)
    while n > 1:
        first, last = lo // ARITY * ARITY, min(hi // ARITY * ARITY + ARITY, n) - 1
        out += [(level, p) for p in (*range(first, lo), *range(hi + 1, last + 1))]
        lo, hi, n, level = lo // ARITY, hi // ARITY, -(-n // ARITY), level + 1
    return out


class Branch:
    """Nodes of an interval of a tree, level by level, completed by fetched ones."""

    def __init__(self, lo: int, hashes: list[str], size: int, level: int, fetched: dict[tuple[int, int], str], top: int | None = None):
        """``hashes`` stand at ``lo``, ``lo + 1``, ... of ``level``; levels are derived up to the tree's
        root, or up to ``top``."""
        self.lo, self.first, n = lo, level, width(size, level)
        #: For each level: first place of the derived nodes, and what stands left and right of each.
        self.sides: list[tuple[int, list[tuple[str, str]]]] = []
        self.levels = [(level, lo, hashes)]
        while n > 1 and (top is None or level < top):
            first, last = lo // ARITY * ARITY, min((lo + len(hashes) - 1) // ARITY * ARITY + ARITY, n) - 1
            whole = ([fetched[level, p] for p in range(first, lo)] + hashes
                     + [fetched[level, p] for p in range(lo + len(hashes), last + 1)])
            runs = [whole[i:i + ARITY] for i in range(0, len(whole), ARITY)]
            sides = [("".join(r[:i]), "".join(r[i + 1:])) for r in runs for i in range(len(r))]
            self.sides.append((lo, sides[lo - first:lo - first + len(hashes)]))
            hashes, lo, n, level = [parent(r) for r in runs], first // ARITY, -(-n // ARITY), level + 1
            self.levels.append((level, lo, hashes))
        self.top = hashes

    def table(self) -> tuple[list[tuple[str, str]], np.ndarray]:
        """Distinct (left, right) entries, and for each held node the entries of its proof."""
        entries, rows = [], np.zeros((len(self.levels[0][2]), len(self.sides)), np.int64)
        place = self.lo + np.arange(len(rows))
        for k, (lo, sides) in enumerate(self.sides):
            rows[:, k] = len(entries) + place - lo
            entries += sides
            place = place // ARITY
        return entries, rows


def _stretches(key: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of every run of equal values."""
    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    if len(key):
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring rows of one unit, whole."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        key = np.asarray(b.column("unit"))
        for lo, hi in _stretches(key):
            if held and held[0].column("unit")[0].as_py() != int(key[lo]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _trees(rows: pa.Table) -> Iterator[tuple[int, int, int, slice]]:
    """(tree, its size, first place, rows) of each tree's part of a unit."""
    tree = np.asarray(rows.column("tree"))
    for lo, hi in _stretches(tree):
        yield int(tree[lo]), rows.column("size")[lo].as_py(), rows.column("place")[lo].as_py(), slice(lo, hi)


def _lifted(batches: Iterator[pa.RecordBatch], levels: int, only_top: bool) -> Iterator[pa.RecordBatch]:
    """Nodes derived from the given ones, ``levels`` levels up or to the root: all of them, or of each
    tree's part of a unit the top one (a lone leaf is its own)."""
    for rows in _units(batches):
        out, hashes, level = [], rows.column("hash").to_pylist(), rows.column("level")[0].as_py()
        for tree, size, lo, s in _trees(rows):
            found = Branch(lo, hashes[s], size, level, {}, level + levels).levels
            out += [(tree, k, at + i, size, h) for k, at, own in (found[-1:] if only_top else found[1:])
                    for i, h in enumerate(own)]
        yield from _nodes(out)


def _nodes(rows: list[tuple]) -> list[pa.RecordBatch]:
    types = {"tree": pa.int64(), "level": pa.int32(), "place": pa.int64(), "size": pa.int64(), "hash": pa.string()}
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(types.items())}).to_batches()


def _unit_of(place: str, levels: int) -> Column:
    return F.call_function("div", F.col(place), F.lit(ARITY ** levels).cast("long"))


def _lift(nodes: DataFrame, levels: int, only_top: bool = False) -> DataFrame:
    """``nodes`` have a ``unit`` that whole runs of them share."""
    return (nodes.repartition("unit").sortWithinPartitions("unit", "tree", "place")
            .mapInArrow(lambda batches: _lifted(batches, levels, only_top), _NODE).checkpoint())


def _upper_nodes(tops: DataFrame, levels: int) -> DataFrame:
    """Nodes from the units' tops up to the roots, ``levels`` levels a round."""
    every, level = tops, levels
    rest = tops.where(F.col("level") == level)
    while rest.agg(F.max("place").alias("last")).first()["last"]:  # else no tree has two nodes left
        # a series of trees to a unit doesn't matter here: they are told apart within it
        nodes = _lift(rest.withColumn("unit", F.xxhash64("tree", _unit_of("place", levels))), levels)
        every, level = every.unionByName(nodes), level + levels
        rest = nodes.where(F.col("level") == level)
    return every


def _ordered(leaves: DataFrame, kept: list[str], levels: int) -> DataFrame:
    """Leaves with ``tree`` (rank of the source, from 0), ``place`` in it, its ``size``, ``trees`` and the
    ``unit``.  Sorted by range, so a source of any size spreads over tasks; equal rows too, by their place
    in the input.  Counts by (source, partition) give the ranks: no group holds more rows than there are
    partitions."""
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), "hash", "tie"]
    dealt = (leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
             .drop("tie").withColumn("at", F.monotonically_increasing_id())
             .withColumn("part", F.shiftright("at", 33)).checkpoint())
    spans = dealt.groupBy("source", "part").agg(F.min("at").alias("from"), F.count(F.lit(1)).alias("n"))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("source", "part", "from", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                         F.sum("n").over(of_source).alias("size"), F.min("part").over(of_source).alias("home")).checkpoint()
    # a source is ranked in the partition where it begins, after the sources and leaves of those before
    homes = spans.where(F.col("part") == F.col("home"))
    counts = homes.groupBy("home").agg(F.count(F.lit(1)).alias("sources"), F.sum("size").alias("leaves")).orderBy("home").collect()
    sources = leaves_before = 0
    offsets = []  # a row a partition
    for r in counts:
        offsets.append((r["home"], sources, leaves_before))
        sources, leaves_before = sources + r["sources"], leaves_before + r["leaves"]
    first = F.broadcast(leaves.sparkSession.createDataFrame(offsets, "home long, trees_before long, leaves_before long"))
    at_home = Window.partitionBy("home").orderBy(F.col("source").asc_nulls_first())
    before = at_home.rowsBetween(Window.unboundedPreceding, -1)
    ranks = homes.join(first, "home").select(
        F.col("source").alias("s"), (F.col("trees_before") + F.row_number().over(at_home) - 1).alias("tree"),
        (F.col("leaves_before") + F.coalesce(F.sum("size").over(before), F.lit(0))).alias("begin"))
    named = (spans.join(ranks, F.col("source").eqNullSafe(F.col("s")))
             .select(F.col("source").alias("s"), F.col("part").alias("p"), "from", "start", "size", "tree", "begin"))
    span = F.lit(ARITY ** levels).cast("long")
    # a part of a large source has the number of its first leaf of all, a series of small sources one below 0
    unit = (F.when(F.col("size") > span, F.col("begin") + F.col("place") - F.col("place") % span)
            .otherwise(-1 - _unit_of("begin", levels)))
    return (dealt.join(named, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
            .withColumn("place", F.col("at") - F.col("from") + F.col("start"))
            .select(*kept, "hash", "tree", "place", "size", F.lit(sources).cast("long").alias("trees"), unit.alias("unit"))
            .checkpoint())


def _requests(units: DataFrame, levels: int) -> DataFrame:
    """(unit, tree, level, place) of the nodes that each unit lacks."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["size"] > ARITY ** levels:  # an aligned part of one tree
                    at = r["place"] // ARITY ** levels
                    out += [(r["unit"], r["low"], *c) for c in missing(at, at, r["size"], levels)]
                out += [(r["unit"], TOP, *c) for c in missing(r["low"], r["high"], r["trees"])]
            types = {"unit": pa.int64(), "tree": pa.int64(), "level": pa.int32(), "place": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types.values())],
                                             list(types))

    return units.mapInArrow(ask, "unit long, tree long, level int, place long")


def _expand(rows: pa.Table, kept: list[str], proof: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Proofs of all leaves of a unit: fetched nodes come first, then the leaves in order."""
    is_leaf = np.array(rows.column("leaf").to_pylist(), bool)
    got = rows.filter(pa.array(~is_leaf)).select(["tree", "level", "place", "hash"]).to_pylist()
    rows = rows.filter(pa.array(is_leaf))
    hashes, trees = rows.column("hash").to_pylist(), rows.column("trees")[0].as_py()
    above = {(r["level"], r["place"]): r["hash"] for r in got if r["tree"] == TOP}
    beside = {(r["level"], r["place"]): r["hash"] for r in got if r["tree"] != TOP}  # of one tree: the others are whole
    parts = [(tree, s, Branch(lo, hashes[s], size, 0, beside)) for tree, size, lo, s in _trees(rows)]
    top = Branch(parts[0][0], [b.top[0] for _, _, b in parts], trees, 0, above)
    upper, path = top.table()
    for k, (_, s, b) in enumerate(parts):
        own, steps = b.table()
        entries = own + [upper[i] for i in path[k]]
        steps = np.hstack([steps, np.broadcast_to(len(own) + np.arange(path.shape[1]), (len(steps), path.shape[1]))])
        left, right = (pa.array([e[i] for e in entries], pa.string()) for i in (0, 1))
        for lo in range(0, len(steps), EMIT):
            part = steps[lo:lo + EMIT]
            flat = pa.array(part.ravel())
            pairs = pa.StructArray.from_arrays([left.take(flat), right.take(flat)], fields=list(proof.value_type))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1]), pairs)
            own_rows = rows.slice(s.start + lo, len(part))
            n = len(part)
            yield from pa.table({**{c: own_rows.column(c) for c in kept}, "hash": own_rows.column("hash"),
                                 "subroot": pa.array([b.top[0]] * n, pa.string()), "root": pa.array([top.top[0]] * n, pa.string()),
                                 "proof": lists.cast(proof)}).to_batches()


def merkle_proofs(docs: DataFrame, source: str, doc_id: str, leaf: Column, carry: dict[str, Column] | None = None,
                  levels: int = LEVELS) -> DataFrame:
    """One row per input row: ``doc_id``, ``source``, the ``carry`` columns, ``leaf``, ``subroot`` (root of the
    source's tree), ``root``, and ``proof``, from the leaf upwards a list of ``left`` and ``right``, the digests
    beside it in its run joined in order (empty where none stand).  Folding a leaf through its
    proof (``folded``) gives the root.

    Per source, leaves ascend by id (nulls first), then by hash; every three consecutive nodes,
    the last run perhaps fewer, have the sha256 of their joined hexadecimal digests as parent.
    The roots of the sources, the null source first, then in UTF-8 order, are joined likewise.
    Repeated rows are leaves of their own, equal ids of a source too; a lone leaf is its own
    subroot; an empty table gives no rows.  Texts stay where they are: only digests, ids and the
    carried columns move.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    carry = carry or {}
    kept = ["id", "source", *(f"c{i}" for i in range(len(carry)))]
    src = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{source}`").alias("source"), leaf.alias("hash"),
                      *[c.alias(f"c{i}") for i, c in enumerate(carry.values())])
    leaves = _ordered(src, kept, levels)
    tops = _lift(leaves.select("unit", "tree", F.lit(0).alias("level"), "place", "size", "hash"), levels, only_top=True)
    nodes = _upper_nodes(tops, levels)
    roots = (nodes.groupBy("tree").agg(F.max_by("hash", "level").alias("hash"))
             .select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"), "hash").checkpoint())
    on_top = roots.withColumn("size", F.lit(roots.count()).cast("long")).select(nodes.columns)
    above = _upper_nodes(_lift(on_top.withColumn("unit", _unit_of("place", levels)), levels), levels)
    nodes = nodes.unionByName(on_top).unionByName(above)

    units = (leaves.groupBy("unit").agg(F.min("tree").alias("low"), F.max("tree").alias("high"), F.min("place").alias("place"),
                                        F.max("size").alias("size"), F.max("trees").alias("trees")))
    fetched = _requests(units, levels).join(nodes.select("tree", "level", "place", "hash"), ["tree", "level", "place"])
    rows = leaves.withColumn("level", F.lit(0)).withColumn("leaf", F.lit(True)).unionByName(
        fetched.withColumn("leaf", F.lit(False)), allowMissingColumns=True)
    proof = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches):
            yield from _expand(unit, kept, proof)

    schema = ", ".join([*(f"{c} {src.schema[c].dataType.simpleString()}" for c in kept),
                        "hash string, subroot string, root string, proof array<struct<left:string,right:string>>"])
    out = rows.repartition("unit").sortWithinPartitions("unit", "leaf", "tree", "place").mapInArrow(prove, schema)
    return out.select(F.col("id").alias(doc_id), F.col("source").alias(source),
                      *[F.col(f"c{i}").alias(n) for i, n in enumerate(carry)], F.col("hash").alias("leaf"), "subroot", "root", "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""), 256)
