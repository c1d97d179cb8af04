"""SimHash near-duplicates by pigeonring filtering (operator 7).

A 64-bit fingerprint is cut into four segments on a ring.  If two fingerprints
differ in at most three bits, some segment starts a chain in which the first
``l`` segments differ in at most ``l * 3 / 4`` bits for every ``l``: 0, 1, 2 and
3 bits.  The first two conditions are a join key (a segment equal, the next one
equal or a bit away), the third and the full distance are checked on the hits.
Only distinct fingerprints take part, so exact copies cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .columns import column, free_name
from .components import connected_components

SEGMENTS, WIDTH = 4, 16
SHINGLE_SEED = 42
#: Fingerprints that one task turns into index and probe rows, about.
ROWS_TO_EXPLODE = 25_000


def fingerprint(text: str | None, shingle_words: int = 3) -> bytes:
    """Eight bytes, most significant first: a bit is set if it is set in over half
    of the XXH64 hashes of the word shingles (repeats count).  A text with fewer
    words is one shingle; one without words, or null, has the fingerprint zero."""
    if text is None:
        return bytes(8)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    votes, n = np.zeros(64, np.int64), max(1, len(words) - shingle_words + 1)
    join, digest = b" ".join, xxhash.xxh64_digest
    for lo in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = words[lo:lo + (1 << 16) + shingle_words - 1]
        rows = (zip(*(part[i:] for i in range(shingle_words)), strict=False)
                if len(words) >= shingle_words else [part])
        h = b"".join([digest(join(r), SHINGLE_SEED) for r in rows])
        votes += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * votes > n).tobytes()


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                      shingle_words: int = 3) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``fp`` (the fingerprint as a signed long).
    Whole texts are read once, where they lie; no text is shuffled."""
    keep = list(keep or [])
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                      F.col(f"`{text}`").alias("text_"))
    schema = ", ".join([*(f"k{i} {src.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "fp long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.frombuffer(b"".join(fingerprint(t, shingle_words) for t in b.column("text_").to_pylist()), ">i8")
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(fp.astype(np.int64))],
                                             [*b.schema.names[:len(keep)], "fp"])

    return src.mapInArrow(run, schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "fp")


def _segment(fp, i: int):
    return F.shiftrightunsigned(fp, WIDTH * (SEGMENTS - 1 - i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _key(i: int, first, second):
    return (F.shiftleft(F.lit(i).cast("long"), 2 * WIDTH).bitwiseOR(F.shiftleft(first, WIDTH)).bitwiseOR(second))


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints in ``fps(fp)`` at most
    ``max_bits`` apart.  A pair may come out more than once."""
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("the four segments serve distances of 0 to 3 bits")
    fp = F.col("fp")
    seg = [_segment(fp, i) for i in range(SEGMENTS)]
    nxt = [seg[(i + 1) % SEGMENTS] for i in range(SEGMENTS)]
    exact = [_key(i, seg[i], nxt[i]) for i in range(SEGMENTS)]
    # segments one bit apart have different parity, so only the odd side needs to try the flips
    odd = [F.bit_count(nxt[i]) % 2 == 1 for i in range(SEGMENTS)]
    flips = [F.when(odd[i], F.array(*[exact[i].bitwiseXOR(F.lit(1 << b)) for b in range(WIDTH)]))
             .otherwise(F.array().cast("array<bigint>")) for i in range(SEGMENTS)]
    index = fps.select(F.explode(F.array(*exact)).alias("key"), fp.alias("a"))
    probe = fps.select(F.explode(F.flatten(F.array(F.array(*exact), *flips))).alias("key"), fp.alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    i = F.shiftright(F.col("key"), 2 * WIDTH)
    bits = [F.bit_count(_segment(x, k)) for k in range(SEGMENTS)]
    chain = F.lit(False)
    for k in range(SEGMENTS):
        chain = chain | ((i == k) & (bits[k] + bits[(k + 1) % SEGMENTS] + bits[(k + 2) % SEGMENTS] <= 2))
    # Spark estimates an exploded array as one row: without the hint it broadcasts up to 68 times the size it expects
    return (index.hint("merge").join(probe, "key").where((F.col("a") != F.col("b")) & chain & (F.bit_count(x) <= max_bits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _classes(fps: DataFrame, best: Column, max_bits: int) -> DataFrame:
    """``fps(fp, ...)`` -> ``(fp, best)``: for every distinct fingerprint the least ``best`` in its component.
    Here and in the callers rows of documents meet by merge joins: a broadcast would pass the driver."""
    nodes = fps.groupBy("fp").agg(F.min(best).alias("low"))
    # a fingerprint is eight bytes here but some thirty rows in the index and the probes: partitions by rows
    parts = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // ROWS_TO_EXPLODE))
    roots = connected_components(links(nodes.select("fp").repartition(parts, "fp"), max_bits))
    joined = nodes.join(roots.hint("merge"), nodes.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    low = joined.groupBy("root").agg(F.min("low").alias("best"))
    return joined.join(low.hint("merge"), "root").select("fp", "best").checkpoint()


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest
    document id reached over links of at most ``max_bits`` bits.

    Null and wordless texts have fingerprint zero and link like any other.  A null
    id never is a component id unless its whole component has none.  Repeated rows
    stay; other columns are ignored; an empty table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    fps = with_fingerprints(docs, text, [doc_id], shingle_words).withColumnRenamed(doc_id, "id_").checkpoint()
    return fps.join(_classes(fps, F.col("id_"), max_bits).hint("merge"), "fp").select(
        F.col("id_").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle_words: int = 3, max_bits: int = 3) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component (of equal ids, one row;
    null ids come last); columns as given.  ``docs`` is a stored table: rows are told
    apart by their place in it."""
    ensure_checkpoint_dir(docs.sparkSession)
    row = free_name(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    fps = with_fingerprints(numbered, text, [doc_id, row], shingle_words).checkpoint()
    best = F.struct(column(doc_id).isNull().alias("none"), column(doc_id).alias("id"), F.col(row).alias("row"))
    kept = _classes(fps, best, max_bits).select(F.col("best.row").alias(row)).distinct()
    return numbered.join(kept.hint("merge"), row, "left_semi").drop(row)
