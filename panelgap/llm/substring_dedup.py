"""Substring deduplication by fixed-block anchors (operator 10).

Every run of ``window`` equal words holds an aligned block of ``(window + 1) // 2``
words of the document it repeats.  So the blocks at multiples of the block length
are indexed, and every rolling block of every document probes the index:

1. *Probe.*  Chunks send the hashes of their rolling blocks, marked where one is an
   anchor, to the buckets of the index; a bucket answers with those that are an
   anchor somewhere and occur in more than one document.
2. *Extend.*  Around the hits, each document's windows are the pieces of maximal
   repeats; chunks send their 80-bit hashes with the smallest document id, and a
   bucket answers with those that some smaller document holds.
3. *Remove.*  The words under such windows go.

The texts are dealt by chunk once; steps 2 and 3 read the same exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .words import ngrams, word_hashes

LAST = np.iinfo(np.int64).max
#: Bits of a block hash that travel beside the bucket.  A false hit (one anchor in some
#: ten thousand) only makes a document send windows that nobody else has.
REST = 34


def _rest(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Block hash cut down to the bits that travel; order is kept."""
    shift = np.uint64(max(0, 64 - (len(starts).bit_length() - 1) - REST))
    return h >> shift << shift


def _blocks(h, docs, block, starts):
    """Hash and validity of the rolling block at each word."""
    grams, whole = ngrams(h, docs, block, 3)
    return _rest(grams, starts), whole


def _word_place(docs: np.ndarray) -> np.ndarray:
    """Position of each word in its document."""
    at = np.arange(len(docs))
    first = C.firsts(docs)
    return at - np.maximum.accumulate(np.where(first, at, 0))


def _probe_rows(texts, chunk, block, starts):
    h, docs = word_hashes(texts)
    grams, whole = _blocks(h, docs, block, starts)
    if not whole.any():
        return
    at = np.flatnonzero(whole)
    anchor = _word_place(docs)[at] % block == 0
    order = np.argsort(grams[at])
    g, d, anchor = grams[at][order], docs[at][order], anchor[order]
    first = np.flatnonzero(C.firsts(g))
    flags = np.maximum.reduceat(anchor.astype(np.uint64), first)
    several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    g = g[first]
    for b, s in C.split(g, starts):
        yield b, chunk, C.pack(((g[s] - starts[b]) & ~np.uint64(3)) | flags[s] | several[s].astype(np.uint64) << np.uint64(1))


def _shared_blocks(rows: pa.Table, starts: np.ndarray) -> pa.Table:
    """A bucket's answer: to every chunk its blocks that are an anchor and lie in two documents."""
    got = [C.unpack(x) for x in rows.column("blob").to_pylist()]
    chunk = rows.column("chunk").to_pylist()
    every = np.concatenate(got)
    order = np.argsort(every >> np.uint64(2), kind="stable")
    key = every[order] >> np.uint64(2)
    first = np.flatnonzero(C.firsts(key))
    count = np.diff(np.append(first, len(key)))
    flag = np.bitwise_or.reduceat(every[order] & np.uint64(3), first)
    shared = key[first][((flag & np.uint64(1)) > 0) & ((count > 1) | (flag > 1))]
    out = [(k, C.pack(hit)) for k, x in zip(chunk, got, strict=True)
           if len(hit := (x >> np.uint64(2))[C.is_in(x >> np.uint64(2), shared)])]
    return pa.table({"chunk": pa.array([k for k, _ in out], pa.int64()),
                     "bucket": pa.array([rows.column("bucket")[0].as_py()] * len(out), pa.int32()),
                     "blob": pa.array([x for _, x in out], pa.binary())})


def _known(rows: pa.Table, starts: np.ndarray) -> np.ndarray:
    """Ascending block hashes from a chunk's answers."""
    got = [(C.unpack(x) << np.uint64(2)) + starts[b]
           for b, x in zip(rows.column("bucket").to_pylist(), rows.column("blob").to_pylist(), strict=True)]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)


def _windows(h, docs, window):
    """64-bit and 16-bit hash of each window, and whether it lies in one document."""
    a, whole = ngrams(h, docs, window, 5)
    b, _ = ngrams(h, docs, window, 7)
    return a, (b >> np.uint64(48)).astype(np.uint16), whole


def _candidates(h, docs, known, block, window, starts):
    """Windows that hold a shared block."""
    grams, whole = _blocks(h, docs, block, starts)
    low = np.zeros(len(grams), np.uint64)
    if len(grams):
        low = starts[np.searchsorted(starts, grams, "right") - 1]
        low = low + ((grams - low) & ~np.uint64(3))
    hit = np.concatenate([[0], np.cumsum(whole & C.is_in(low, known))])
    size = max(0, len(h) - window + 1)
    return (hit[window - block + 1:][:size] - hit[:size]) > 0


def _beaten(rows: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's windows that a smaller document of another chunk holds, by ascending key."""
    got = [(C.unpack(x) + starts[b], np.frombuffer(y, np.uint16)) for b, x, y in zip(
        *(rows.column(c).to_pylist() for c in ("bucket", "keys", "checks")), strict=True)]
    if not got:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    x, y = (np.concatenate([g[i] for g in got]) for i in (0, 1))
    order = np.lexsort((y, x))
    return x[order], y[order]


def _pairs_in(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) are among the pairs (x, y); each side holds a pair once."""
    both = np.lexsort((np.append(np.zeros(len(a), np.int8), np.ones(len(x), np.int8)), np.append(b, y), np.append(a, x)))
    left, right = np.append(a, x)[both], np.append(b, y)[both]
    same = np.zeros(len(both), bool)
    same[:-1] = (left[1:] == left[:-1]) & (right[1:] == right[:-1])
    out = np.zeros(len(a), bool)
    mine = both < len(a)
    out[both[mine]] = same[mine]
    return out


def _digest(text: bytes, emit: str) -> str:
    return text.decode("utf-8", "surrogatepass") if emit == "text" else hashlib.sha256(text).hexdigest()


_DONE = "doc long, n_words long, n_removed long, kept string"


def _doc_ids(table: pa.Table) -> np.ndarray:
    """Ids for comparison: a null id counts as larger than any other."""
    return np.array([LAST if x is None else x for x in table.column("doc").to_pylist()], np.int64)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13,
                   emit: str = "text") -> DataFrame:
    """Removes each word under a window of ``window`` words that also starts in a
    document with a smaller id.  One row per input row: ``doc_id``, ``n_words``,
    ``n_removed`` and ``kept``, the words left joined by single spaces
    (``emit="text"``) or the SHA-256 of that in hexadecimal (``emit="sha256"``).

    Windows are judged on the input.  A null text has no words; texts shorter than
    the window stay whole.  Rows with equal ids never remove each other's words; a
    null id is larger than any other; ids are whole numbers and come back as long.  Other columns
    are ignored; an empty table gives no rows.  Rows are told apart by their place in their input partition, so ``docs`` is a stored table.
    """
    block = (window + 1) // 2
    size = C.text_bytes(docs, text)
    starts, parts = C.bucket_starts(C.bucket_count(docs, text, size)), C.partitions(docs, size)
    src = C.with_chunks(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"),
                                    F.col(f"`{text}`").alias("body")), "body")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in C.whole_chunks(batches):
            if out := list(_probe_rows(rows.column("body").to_pylist(), k, block, starts)):
                yield from C.table(out, "bucket int, chunk long, blob binary").to_batches()

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = "bucket int, chunk long, keys binary, checks binary, ids binary"
        if not (left.num_rows and right.num_rows):
            return C.table([], schema)
        ids, k = _doc_ids(left), left.column("chunk")[0].as_py()
        h, docs = word_hashes(left.column("body").to_pylist())
        cand = _candidates(h, docs, _known(right, starts), block, window, starts)
        a, b, whole = _windows(h, docs, window)
        at = np.flatnonzero(cand & whole)
        order = at[np.lexsort((ids[docs[at]], b[at], a[at]))]
        keep = order[C.firsts(a[order]) | C.firsts(b[order])]
        return C.table([(bucket, k, C.pack(a[keep[s]] - starts[bucket]), b[keep[s]].tobytes(),
                         C.pack_counts(ids[docs[keep[s]]])) for bucket, s in C.split(a[keep], starts)], schema)

    def decide(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        got = [(k, C.unpack(x), np.frombuffer(y, np.uint16), C.unpack_counts(z).astype(np.int64)) for k, x, y, z in zip(
            *(rows.column(c).to_pylist() for c in ("chunk", "keys", "checks", "ids")), strict=True)]
        a, b, d = (np.concatenate([g[i] for g in got]) for i in (1, 2, 3))
        order = np.lexsort((b, a))
        first = C.firsts(a[order]) | C.firsts(b[order])
        low = np.empty(len(a), np.int64)
        low[order] = np.minimum.reduceat(d[order], np.flatnonzero(first))[np.cumsum(first) - 1]
        beaten, lo, out = low < d, 0, []
        for k, x, y, _ in got:
            own = beaten[lo:lo + len(x)]
            lo += len(x)
            if own.any():
                out.append((bucket, k, C.pack(x[own]), y[own].tobytes()))
        return C.table(out, "bucket int, chunk long, keys binary, checks binary")

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return C.table([], _DONE)
        texts, ids = left.column("body").to_pylist(), _doc_ids(left)
        h, docs = word_hashes(texts)
        a, b, whole = _windows(h, docs, window)
        x, y = _beaten(right, starts)
        at = np.flatnonzero(whole)
        at = at[np.argsort(a[at])]
        more = C.firsts(a[at])
        more = ~more | np.append(~more[1:], np.zeros(min(1, len(at)), bool))  # equal to a neighbour in the chunk
        at = at[more | C.is_in(a[at], x)]
        # smallest id of each window in this chunk, and the windows that lose to another chunk
        order = at[np.lexsort((ids[docs[at]], b[at], a[at]))]
        first = C.firsts(a[order]) | C.firsts(b[order])
        own, group = order[first], np.cumsum(first) - 1
        lost = _pairs_in(a[own], b[own], x, y)
        gone = order[lost[group] | (ids[docs[own]][group] < ids[docs[order]])]
        edge = np.bincount(gone, minlength=len(h) + 1)[:len(h) + 1] - np.bincount(gone + window, minlength=len(h) + 1)
        drop = np.cumsum(edge[:-1]) > 0
        rows, lo = [], 0
        n = np.bincount(docs, minlength=len(texts)).tolist()
        for i, t in enumerate(texts):
            cut = drop[lo:lo + n[i]]
            lo += n[i]
            words = (t or "").encode("utf-8", "surrogatepass").split()
            if cut.any():
                words = [w for w, gone_too in zip(words, cut.tolist(), strict=True) if not gone_too]
            rows.append((left.column("doc")[i].as_py(), n[i], n[i] - len(words),
                         _digest(b" ".join(words), emit)))
        return C.table(rows, _DONE)

    probes = src.mapInArrow(probe, "bucket int, chunk long, blob binary")
    hits = probes.repartition(parts, "bucket").groupBy("bucket").applyInArrow(lambda t: _shared_blocks(t, starts),
                                                 "chunk long, bucket int, blob binary")
    texts = src.select("chunk", "doc", "body").repartition(parts, "chunk")
    windows = texts.groupBy("chunk").cogroup(hits.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(
        extend, "bucket int, chunk long, keys binary, checks binary, ids binary")
    beaten = windows.repartition(parts, "bucket").groupBy("bucket").applyInArrow(decide, "bucket int, chunk long, keys binary, checks binary")
    return (texts.groupBy("chunk").cogroup(beaten.repartition(parts, "chunk").groupBy("chunk")).applyInArrow(remove, _DONE)
            .withColumnRenamed("doc", doc_id))
