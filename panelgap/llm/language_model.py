"""Language-model scoring with a log-frequency Bloom filter (operator 9).

Unigram and bigram counts of the training texts are quantised on a logarithmic
scale, ``level = floor(log2(count / UNIT))``, and an n-gram of level ``l`` enters a
Bloom filter as the keys (n-gram, 1) ... (n-gram, l).  Its level is read back by
probing 1, 2, ... until one is absent, so an error only raises a level, one step
with a small probability, two with its square.

``UNIT`` is a constant, and every n-gram of the training texts enters from its first
occurrence on, whatever the size of the corpus.  The filter is split by hash range into
blocks of bounded size, whose number grows with the corpus.

``fit`` reads training texts alone and leaves a stored model: the blocks, with
``BITS_PER_KEY`` bits a key, the mean count of each level, and, for the exact unigram
baseline only, the words' totals.  ``score_with`` scores any table against a stored model:
a chunk of documents sends each block its distinct n-grams (no counts), the block answers
with the levels that its probes give, and the scores rest on these.  No n-gram's count
reaches the model's score in any other way.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import chunks as C
from .words import mix, word_hashes

#: Half an occurrence: a count of 1 is level 1, 2 and 3 are level 2, and so on.
UNIT = 0.5
BITS_PER_KEY, PROBES = 12, 6
#: Weight of the bigram estimate in the mixture with the unigram estimate.
BIGRAM_WEIGHT = 0.1
END = np.uint64(0x5DEECE66D1234567)
#: Bits of a bigram's hash that are kept beside its bucket; a bucket holds under a million n-grams.
REST = 32


class LogBloom:
    """Levels of 64-bit keys in a bit array; immutable once built."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, 8 * len(bits)

    @classmethod
    def of(cls, keys: np.ndarray, level: np.ndarray) -> LogBloom:
        """The filter that holds each key up to its level."""
        bits = np.zeros(8 * -(-max(1, BITS_PER_KEY * int(level.sum())) // 8), bool)
        for v in range(1, int(level.max(initial=0)) + 1):
            own = keys[level >= v]
            for i in range(PROBES):
                bits[cls.place(own, v, i, len(bits))] = True
        return cls(np.packbits(bits, bitorder="little"))

    @staticmethod
    def place(keys: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
        a = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
        return (a + np.uint64(probe) * (mix(a) | np.uint64(1))) % np.uint64(size)

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        alive = np.arange(len(keys))
        for i in range(PROBES):
            at = self.place(keys[alive], level, i, self.size)
            alive = alive[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        out = np.zeros(len(keys), bool)
        out[alive] = True
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        alive, level = np.arange(len(keys)), 1
        while len(alive):
            alive = alive[self.has(keys[alive], level)]
            out[alive] = level
            level += 1
        return out


def level_of(count: np.ndarray, unit: float) -> np.ndarray:
    """0 below two units, then one more with each doubling."""
    return np.maximum(0, np.floor(np.log2(np.maximum(count, 1) / unit))).astype(np.int64)


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts (A-Z lower-cased) with an end after each, and the text of each token."""
    h, docs = word_hashes(texts, lower=True)
    stop = np.searchsorted(docs, np.arange(len(texts)), "right")
    return np.insert(h, stop, END), np.insert(docs, stop, np.arange(len(texts)))


def _bigrams(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token after the one before; every text begins after an end."""
    before = np.concatenate([[END], tokens[:-1]])
    return mix(before * np.uint64(0xD1B54A32D192ED03) + tokens)


def _cut(h: np.ndarray, buckets: int) -> np.ndarray:
    shift = np.uint64(max(0, 64 - (buckets.bit_length() - 1) - REST))
    return h >> shift << shift


_COUNTS = "kind int, bucket int, chunk long, keys binary, counts binary"
_ASKED = "kind int, bucket int, chunk long, keys binary"
_BLOCKS = "kind int, bucket int, bits binary, words binary, counts binary, level int, types long, total long"
_ANSWERS = "kind int, bucket int, chunk long, counts binary, levels binary"


def _packed(chunk: int, kind: int, key: np.ndarray, starts: np.ndarray, *more: np.ndarray) -> list[tuple]:
    """What a chunk tells each bucket about the ascending ``key``."""
    return [(kind, b, chunk, C.pack(key[s] - starts[b]), *(C.pack_counts(m[s]) for m in more)) for b, s in C.split(key, starts)]


def _chunk_counts(chunk: int, rows: pa.Table, starts: np.ndarray) -> pa.Table:
    """The words and bigrams of a chunk of training texts, with their counts."""
    tokens, _ = _tokens(rows.column("body").to_pylist())
    words, n = C.tally(tokens)
    pairs, m = C.tally(_cut(_bigrams(tokens), len(starts)))
    return C.table(_packed(chunk, 1, words, starts, n) + _packed(chunk, 2, pairs, starts, m), _COUNTS)


def _chunk_asks(chunk: int, rows: pa.Table, starts: np.ndarray) -> pa.Table:
    """The distinct words and bigrams of a chunk of any texts."""
    tokens, _ = _tokens(rows.column("body").to_pylist())
    return C.table(_packed(chunk, 1, np.unique(tokens), starts)
                   + _packed(chunk, 2, np.unique(_cut(_bigrams(tokens), len(starts))), starts), _ASKED)


def _block(rows: pa.Table, starts: np.ndarray) -> pa.Table:
    """A bucket's block of the filter, its words' totals, and for each level the n-grams and their occurrences."""
    kind, bucket = rows.column("kind")[0].as_py(), rows.column("bucket")[0].as_py()
    keys = np.concatenate([C.unpack(x) for x in rows.column("keys").to_pylist()])
    counts = np.concatenate([C.unpack_counts(x) for x in rows.column("counts").to_pylist()])
    key, total = C.tally(keys, counts)
    level = level_of(total, UNIT)
    bits = LogBloom.of(_filter_key(key + starts[bucket], kind), level).bits.tobytes()
    exact = (C.pack(key), C.pack_counts(total)) if kind == 1 else (None, None)
    out = [(kind, bucket, bits, *exact, None, None, None)]
    out += [(kind, bucket, None, None, None, v, int((level == v).sum()), int(total[level == v].sum()))
            for v in np.unique(level).tolist()]
    return C.table(out, _BLOCKS)


def _answer(asked: pa.Table, block: pa.Table, starts: np.ndarray) -> pa.Table:
    """To each chunk the levels of its n-grams, by probing the block, and the totals of its words.
    Without a block nothing of the bucket was seen."""
    if not asked.num_rows:
        return C.table([], _ANSWERS)
    kind, bucket = asked.column("kind")[0].as_py(), asked.column("bucket")[0].as_py()
    keys = [C.unpack(x) for x in asked.column("keys").to_pylist()]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    level, total = np.zeros(len(every), np.uint64), np.zeros(len(every), np.uint64)
    if block.num_rows:
        bits = np.frombuffer(block.column("b_bits")[0].as_py(), np.uint8)
        level = LogBloom(bits).levels(_filter_key(every + starts[bucket], kind)).astype(np.uint64)
        if kind == 1:
            words = C.unpack(block.column("b_words")[0].as_py())
            known = C.is_in(every, words)
            total[known] = C.unpack_counts(block.column("b_counts")[0].as_py())[np.searchsorted(words, every[known])]
    out, lo = [], 0
    for chunk, own in zip(asked.column("chunk").to_pylist(), keys, strict=True):
        at = place[lo:lo + len(own)]
        out.append((kind, bucket, chunk, C.pack_counts(total[at]) if kind == 1 else None, C.pack_counts(level[at])))
        lo += len(own)
    return C.table(out, _ANSWERS)


def _filter_key(h: np.ndarray, kind: int) -> np.ndarray:
    return mix(h + np.uint64(kind))


@dataclass(frozen=True)
class StoredModel:
    """A fitted model under ``path``, a shared folder."""

    path: str
    buckets: int
    #: tokens and distinct tokens of the training texts
    n: int
    v: int
    #: mean count of each level, by order of the n-gram
    mean: dict

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StoredModel:
        stats = (spark.read.parquet(f"{path}/blocks").where("level is not null").groupBy("kind", "level")
                 .agg(F.sum("types").alias("types"), F.sum("total").alias("total")).collect())  # a row a level
        n, v = (sum(r[c] for r in stats if r["kind"] == 1) for c in ("total", "types"))
        return cls(path, spark.read.parquet(f"{path}/about").first()["buckets"], n, v, _level_means(stats))

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/blocks").where("level is null")


def fit(docs: DataFrame, text: str = "text", path: str | None = None) -> StoredModel:
    """Learns from all rows of ``docs`` and stores the model under ``path`` (by default in the session's
    shared checkpoint folder).  A null text is empty and has its end; repeated rows count as often as
    they occur; an empty table gives a model that has seen nothing."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/language-model-{uuid.uuid4().hex}"
    size = C.text_bytes(docs, text)
    buckets = C.bucket_count(docs, text, size)
    starts = C.bucket_starts(buckets)
    src = C.with_chunks(docs.select(F.col(f"`{text}`").alias("body")), "body")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in C.whole_chunks(batches):
            yield from _chunk_counts(chunk, rows, starts).to_batches()

    (src.select("rid", "chunk", "body").mapInArrow(count, _COUNTS).repartition(C.partitions(docs, size), "kind", "bucket")
     .groupBy("kind", "bucket").applyInArrow(lambda t: _block(t, starts), _BLOCKS).write.parquet(f"{path}/blocks"))
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{path}/about")
    return StoredModel.load(spark, path)


def score_with(docs: DataFrame, model: StoredModel, doc_id: str = "doc_id", text: str = "text",
               carry: list[str] | None = None) -> DataFrame:
    """Scores all rows of ``docs``, which need not have taken part in the fit: ``doc_id``, the
    ``carry`` columns, ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens``,
    ``base_score`` (exact unigram log10 probability, 0.5 added to each count and one more
    type) and ``score``, log10 of ``w * P(token | token before) + (1 - w) * P(token)`` summed
    over the tokens, with counts as the filter gives them: the mean count of the level.

    Tokens are the words, A-Z lower-cased, then one end.  A null text is empty.  Under a model
    that has seen nothing every token has the same probability.  Repeated rows give repeated
    rows.  Rows are told apart by their place in their input partition, so ``docs`` is a stored table.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    carry = list(carry or [])
    starts, parts = C.bucket_starts(model.buckets), C.partitions(docs, C.text_bytes(docs, text))
    src = C.with_chunks(docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("body"),
                                    *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]), "body")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in C.whole_chunks(batches):
            yield from _chunk_asks(chunk, rows, starts).to_batches()

    asked = src.select("rid", "chunk", "body").mapInArrow(ask, _ASKED).repartition(parts, "kind", "bucket")
    blocks = model.blocks(docs.sparkSession).select(*[F.col(c).alias(f"b_{c}") for c in ("kind", "bucket", "bits", "words", "counts")])
    answers = (asked.groupBy("kind", "bucket").cogroup(blocks.repartition(parts, "b_kind", "b_bucket").groupBy("b_kind", "b_bucket"))
               .applyInArrow(lambda a, b: _answer(a, b, starts), _ANSWERS))
    kept = ["doc", *(f"c{i}" for i in range(len(carry)))]
    schema = ", ".join([*(f"{c} {src.schema[c].dataType.simpleString()}" for c in kept),
                        "n_tokens long, n_known long, base_score double, score double"])
    mean, n, v = model.mean, model.n, model.v

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score_chunk(left, right, kept, starts, mean, n, v)

    scored = (src.select("chunk", "body", *kept).repartition(parts, "chunk").groupBy("chunk")
              .cogroup(answers.select(F.col("chunk").alias("of"), "kind", "bucket", "counts", "levels").repartition(parts, "of").groupBy("of"))
              .applyInArrow(score, schema))
    return scored.select(F.col("doc").alias(doc_id), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                         "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def score_texts(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
                carry: list[str] | None = None) -> DataFrame:
    """Learns from the rows where ``train`` holds (null counts as false) and scores all rows, as ``score_with``
    does.  Nulls, empty tables and repeated rows as there and in ``fit``."""
    return score_with(docs, fit(docs.where(F.coalesce(train, F.lit(False))), text), doc_id, text, carry)


def _level_means(stats: list) -> dict[int, np.ndarray]:
    """Mean count of each level by order; level 0 is absent from training."""
    out = {}
    for kind in (1, 2):
        own = {r["level"]: r["total"] / r["types"] for r in stats if r["kind"] == kind}
        mean = np.zeros(80)
        for level in range(1, 80):  # an empty level (a false probe) takes the mean of the one below
            mean[level] = own.get(level, mean[level - 1])
        out[kind] = mean
    return out


def _score_chunk(left, right, kept, starts, mean, n, v) -> pa.Table:
    texts = left.column("body").to_pylist()
    tokens, docs = _tokens(texts)
    order = np.argsort(tokens, kind="stable")
    first = C.firsts(tokens[order])
    word = np.empty(len(tokens), np.int64)  # place of each token among the chunk's distinct words
    word[order] = np.cumsum(first) - 1
    keys = tokens[order][first]
    pair, back = np.unique(_cut(_bigrams(tokens), len(starts)), return_inverse=True)
    answers = {(k, b): (c, x) for k, b, c, x in zip(
        *(right.column(c).to_pylist() for c in ("kind", "bucket", "counts", "levels")), strict=True)}
    count, seen, joint = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(pair))
    for b, s in C.split(keys, starts):
        count[s] = C.unpack_counts(answers[1, b][0])
        seen[s] = mean[1][C.unpack_counts(answers[1, b][1])]
    for b, s in C.split(pair, starts):
        joint[s] = mean[2][C.unpack_counts(answers[2, b][1])]
    joint = joint[back]
    whole = n + 0.5 * (v + 1)
    base = np.log10((count + 0.5) / whole)[word]
    before = np.concatenate([[np.searchsorted(keys, END)], word[:-1]])
    p = BIGRAM_WEIGHT * np.minimum(1.0, joint / np.maximum(seen[before], 0.5)) \
        + (1 - BIGRAM_WEIGHT) * (seen[word] + 0.5) / whole
    size = len(texts)
    cols = {c: left.column(c) for c in kept}
    cols["n_tokens"] = pa.array(np.bincount(docs, minlength=size))
    cols["n_known"] = pa.array(np.bincount(docs, (count > 0)[word], minlength=size).astype(np.int64))
    cols["base_score"] = pa.array(np.bincount(docs, base, minlength=size))
    cols["score"] = pa.array(np.bincount(docs, np.log10(p), minlength=size))
    return pa.table(cols)
