"""Chunks of documents that exchange sorted hashes in packed form.

Some operators ask, for every position of every text, which other documents hold
the same hash.  A row per position would make the exchange several times the
input.  Here a task works on a *chunk* of neighbouring documents, sorts its
distinct hashes, and sends each *bucket* (a range of the hash space) one packed
array; the bucket answers each chunk with the entries that matter.  Repeats
within a chunk are merged before anything is sent, so neither a hot passage nor
a hot source makes a large group: a bucket gets a hash once a chunk at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents to a chunk by text size in bytes: a chunk holds 128 MB of text at most, or one document.
SMALL, LARGE = 1 << 16, 1 << 20
ROWS = (2048, 64, 1)
BUCKETS_PER_PARTITION = 4
#: Bytes of text to a bucket at most: about 40 MB of 64-bit hashes, one a word.
BUCKET_TEXT = 1 << 25
#: Bytes of text to a partition of an exchange, about.
PART_TEXT = 1 << 24


def with_chunks(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``rid``, a row id, and ``chunk``.  Both follow from the place of the row
    in its input partition, so a task that runs again gives the same ones."""
    rid, size = F.col("rid"), F.coalesce(F.octet_length(F.col(text)), F.lit(0))
    place = rid.bitwiseAND(F.lit((1 << 33) - 1))

    def group(kind: int) -> Column:
        return (F.shiftleft(F.shiftright(rid, 33), 33)
                .bitwiseOR(F.shiftleft(F.floor(place / ROWS[kind]), 2)).bitwiseOR(F.lit(kind).cast("long")))

    return (docs.withColumn("rid", F.monotonically_increasing_id())
            .withColumn("chunk", F.when(size < SMALL, group(0)).when(size < LARGE, group(1)).otherwise(group(2))))


def whole_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Every chunk of an input partition with all its rows, as soon as the last has come."""
    held: dict[int, list[pa.RecordBatch]] = {}

    def end(chunk: int) -> int:
        return (((chunk & ((1 << 33) - 1)) >> 2) + 1) * ROWS[chunk & 3]

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.asarray(batch.column("chunk"))
        for k in np.unique(key).tolist():
            held.setdefault(k, []).append(batch.filter(pa.array(key == k)))
        seen = (batch.column("rid")[-1].as_py() & ((1 << 33) - 1)) + 1
        for k in [k for k in held if end(k) <= seen]:
            yield k, pa.Table.from_batches(held.pop(k))
    for k, rows in held.items():
        yield k, pa.Table.from_batches(rows)


_ARROW = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}


def table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows under a schema of plain types, written as for Spark."""
    fields = [f.split() for f in schema.split(", ")]
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table({n: pa.array(list(c), _ARROW[t]) for (n, t), c in zip(fields, cols, strict=True)})


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return df.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0


def partitions(df: DataFrame, size: int) -> int:
    """Partitions for an exchange of texts of ``size`` bytes: their size does not grow with the input."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PART_TEXT))


def bucket_count(df: DataFrame, text: str, size: int | None = None) -> int:
    """Buckets of the hash space: a few a shuffle partition, and as many more as the bytes
    of all texts ask for, so that a bucket's size does not grow with the input."""
    size = text_bytes(df, text) if size is None else size
    return max(BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_TEXT))


def bucket_starts(n: int) -> np.ndarray:
    """First hash of every bucket, in ascending order."""
    return np.array([(i << 64) // n for i in range(n)], np.uint64)


def split(sorted_hashes: np.ndarray, starts: np.ndarray):
    """(bucket, slice) of every bucket with a hash."""
    cut = np.append(np.searchsorted(sorted_hashes, starts), len(sorted_hashes))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), slice(cut[b], cut[b + 1])


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences of the fewest whole bytes that hold them."""
    step = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return pack_counts(step)


def pack_counts(values: np.ndarray) -> bytes:
    """64-bit values in any order, in the fewest whole bytes that hold them."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    width = blob[0]
    wide = np.zeros(((len(blob) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    return wide.view("<u8").ravel().astype(np.uint64)


def unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_counts(blob), dtype=np.uint64)


def is_in(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in an ascending set."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def tally(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order with their number or summed weights."""
    if weights is None:
        v = np.sort(values)
        at = np.flatnonzero(firsts(v))
        return v[at], np.diff(np.append(at, len(v))).astype(np.uint64)
    order = np.argsort(values, kind="stable")
    v = values[order]
    at = np.flatnonzero(firsts(v))
    return v[at], (np.add.reduceat(weights[order], at) if len(at) else weights[:0])


def firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Marks the first of every run of equal values."""
    mark = np.ones(len(sorted_values), bool)
    mark[1:] = sorted_values[1:] != sorted_values[:-1]
    return mark
