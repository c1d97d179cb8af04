"""Benchmark decontamination by spaced-seed hashing (operator 4).

A mask reads the tokens at some offsets and ignores the others, so a changed
token at an ignored place leaves the seed's hash as it was.  Seeds of the test
items and of the training texts are joined on their hash; around each hit the
texts are laid over one another and compared token by token.

The test set is the small side, read in blocks of at most ``BLOCK_WORDS`` words;
a block's seeds are broadcast (their size is bounded by that), and every training
text is compared with every block in full, where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import free_name
from .words import mix, slices, word_hashes

#: Token offsets that a seed reads.  Together they meet every overlap of 8 to 16
#: tokens with up to a fifth of them substituted (test_decontaminate proves it).
MASKS = ((0, 1, 2, 4, 5), (0, 1, 4, 6, 7), (0, 1, 2, 3, 4))
MAX_WINDOW, MIN_WINDOW, SIMILARITY = 16, 8, 0.8
BLOCK_WORDS = 2_000_000


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every token: the words in lower case (all scripts)."""
    return word_hashes([t and t.lower() for t in texts])


def seeds(words: np.ndarray, mask: tuple[int, ...], kind: int) -> np.ndarray:
    """Hash of the masked tokens from each position on at which the mask fits."""
    size = len(words) - mask[-1]
    if size <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(size, np.uint64(kind + 1))
    for x in mask:
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[x:x + size]
    return mix(acc)


@dataclass
class Block:
    """Seeds of one block of test items, ascending, and where they lie."""

    items: list            # item ids
    words: np.ndarray      # token hashes of all items
    start: np.ndarray      # first token of each item, and the end
    seed: np.ndarray       # ascending
    place: np.ndarray      # token position of each seed
    sieve: np.ndarray      # bitmap over 24 bits of the seeds

    @classmethod
    def of(cls, items: list, texts: list[str | None]) -> Block:
        words, docs = tokens(texts)
        start = np.searchsorted(docs, np.arange(len(texts) + 1))
        size = np.diff(start)
        seed, place = [], []
        for kind, mask in enumerate(MASKS):
            h = seeds(words, mask, kind)
            at = np.flatnonzero(docs[:len(h)] == docs[mask[-1]:]) if len(h) else np.zeros(0, np.int64)
            at = at[size[docs[at]] >= MIN_WINDOW]
            seed.append(h[at])
            place.append(at)
        seed, place = np.concatenate(seed), np.concatenate(place)
        order = np.argsort(seed, kind="stable")
        sieve = np.zeros(1 << 24, bool)
        sieve[seed >> np.uint64(40)] = True
        return cls(items, words, start, seed[order], place[order], sieve)

    def hits(self, words: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Distinct (document, item, first token of the document minus that of the item)."""
        found = [np.zeros((0, 3), np.int64)]
        for kind, mask in enumerate(MASKS):
            h = seeds(words, mask, kind)
            at = np.flatnonzero(self.sieve[h >> np.uint64(40)])
            at = at[docs[at] == docs[at + mask[-1]]]
            lo, hi = np.searchsorted(self.seed, h[at]), np.searchsorted(self.seed, h[at], "right")
            n = hi - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            # every place of a seed, as one array
            own = np.repeat(np.arange(len(at)), n)
            place = self.place[lo[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)]
            item = np.searchsorted(self.start, place, "right") - 1
            found.append(np.stack([docs[at[own]], item, at[own] - (place - self.start[item])], 1))
        return np.unique(np.concatenate(found), axis=0)

    def verify(self, words: np.ndarray, docs: np.ndarray, doc_start: np.ndarray) -> Iterator[tuple]:
        """(document, item index, first token, tokens, equal tokens) of the longest overlap
        of each pair that has one."""
        best: dict[tuple[int, int], tuple] = {}
        for d, item, shift in self.hits(words, docs).tolist():
            first, last = self.start[item], self.start[item + 1]
            lo, hi = max(shift, doc_start[d]), min(shift + last - first, doc_start[d + 1])
            window = min(MAX_WINDOW, int(last - first))
            if hi - lo < window:
                continue
            same = words[lo:hi] == self.words[first + lo - shift:first + hi - shift]
            run = np.cumsum(np.concatenate([[0], same]))
            good = np.flatnonzero(run[window:] - run[:-window] >= np.ceil(SIMILARITY * window))
            if not len(good):
                continue
            cover = np.zeros(hi - lo, bool)
            for g in good:
                cover[g:g + window] = True
            n, eq = int(cover.sum()), int((cover & same).sum())
            row = (eq, n, -(int(lo) + int(good[0]) - int(doc_start[d])))
            if row > best.get((d, item), (0, 0, 0)):
                best[d, item] = row
        for (d, item), (eq, n, at) in best.items():
            yield d, item, -at, n, eq


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
             item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS,
             row_id: str | None = None) -> DataFrame:
    """One row for each document and test item that share an overlap: ``doc_id``,
    ``item_id``, ``first_word`` (in the document, from 0), ``n_words`` and ``n_equal``.

    Tokens are the words in lower case.  An overlap is a run of min(16, length of
    the item) tokens of which at least four in five are equal, or several such runs
    on one alignment; where a pair overlaps on several, the one with most equal
    tokens counts, then the first.  Items shorter than eight tokens are no evidence
    and match nothing.  Null texts have no tokens; an empty table gives no rows;
    repeated rows give repeated results.  ``row_id`` names a column to carry along.
    """
    spark = docs.sparkSession
    id_type = benchmark.schema[item_id].dataType.simpleString()
    src = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("body"),
                      *([F.col(f"`{row_id}`").alias("row")] if row_id else []))
    carried = ["doc", "row"] if row_id else ["doc"]
    schema = ", ".join([f"{c} {src.schema[c].dataType.simpleString()}" for c in carried]
                       + [f"item {id_type}", "first_word int", "n_words int", "n_equal int"])
    arrow = pa.string() if id_type == "string" else None  # else inferred: an integer
    tests = benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("body"))
    total = tests.agg(F.sum(F.size(F.split("body", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    n_blocks = 1 + total // block_words
    out = None
    for k in range(n_blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "body"), F.lit(n_blocks)) == k).collect()
        block = spark.sparkContext.broadcast(Block.of([r.item for r in part], [r.body for r in part]))

        def match(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            b = block.value
            for batch in batches:
                texts = batch.column("body").to_pylist()
                rows = []
                for s in slices(texts):
                    words, docs = tokens(texts[s])
                    start = np.searchsorted(docs, np.arange(s.stop - s.start + 1))
                    rows += [(s.start + d, b.items[i], *x) for d, i, *x in b.verify(words, docs, start)]
                if rows:
                    at = pa.array([r[0] for r in rows])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(at) for c in carried), pa.array([r[1] for r in rows], arrow),
                         *(pa.array([r[i] for r in rows], pa.int32()) for i in (2, 3, 4))],
                        [*carried, "item", "first_word", "n_words", "n_equal"])

        hit = src.mapInArrow(match, schema)
        out = hit if out is None else out.unionByName(hit)
    return out.select(F.col("doc").alias(doc_id), *([F.col("row").alias(row_id)] if row_id else []),
                      F.col("item").alias(item_id), "first_word", "n_words", "n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without an overlap with a test item; columns as given."""
    row = free_name(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    hit = overlaps(numbered, benchmark, doc_id, text, row_id=row).select(row).distinct()
    return numbered.join(hit, row, "left_anti").drop(row)
