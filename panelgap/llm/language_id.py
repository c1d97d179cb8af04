"""Language identification by hyperdimensional profiles (operator 6).

Each letter has a random vector of +1 and -1, drawn from its code point.  A trigram
is the product of its letters' vectors, the first rotated by two places, the second
by one; a text is the sum of its trigrams, a language the sum of its training texts.
A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import slices

_SPACE = re.compile(r"\s")
DIMENSION = 1024
SLICE_CHARS = 1 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


@cache
def _letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng([code, 1024]).integers(0, 2, DIMENSION, dtype=np.int8) * 2 - 1


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points (three a row) of all trigrams and the text of each, and whether a text
    has a letter.  Letters are lower-cased; what lies between them is one space."""
    lowered = ["" if t is None else t.lower() for t in texts]
    whole = " ".join(["", *lowered, ""])
    code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    doc = np.append(doc, len(texts))  # the first space belongs to the first text, the last one to none
    letter = _letters()[code]
    code = np.where(letter, code, 32)
    keep = letter | np.append(True, letter[:-1])
    code, doc, letter = code[keep], doc[keep], letter[keep]
    has = np.bincount(doc[letter], minlength=len(texts))[:len(texts)] > 0
    if len(code) < 3:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), has
    tri = np.stack([code[:-2], code[1:-1], code[2:]], 1)
    ok = letter[1:-1]  # the middle is a letter, so all three belong to its text or its borders
    return tri[ok], doc[1:-1][ok], has


def _vectors(tri: np.ndarray) -> np.ndarray:
    """One vector a trigram."""
    code, at = np.unique(tri, return_inverse=True)
    letter = np.stack([_letter_vector(int(c)) for c in code])
    at = at.reshape(tri.shape)
    return np.roll(letter, 2, axis=1)[at[:, 0]] * np.roll(letter, 1, axis=1)[at[:, 1]] * letter[at[:, 2]]


def _distinct(tri: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams and the place of each one among them."""
    seen = np.zeros(0x110000, bool)
    seen[tri.ravel()] = True
    code = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.int64)
    number[code] = np.arange(len(code))
    n = len(code)
    key = (number[tri[:, 0]] * n + number[tri[:, 1]]) * n + number[tri[:, 2]]
    if n ** 3 <= 1 << 24:
        there = np.zeros(n ** 3, bool)
        there[key] = True
        own = np.flatnonzero(there)
        place = np.zeros(n ** 3, np.int64)
        place[own] = np.arange(len(own))
        at = place[key]
    else:
        own, at = np.unique(key, return_inverse=True)
    return np.stack([code[own // (n * n)], code[own // n % n], code[own % n]], 1), at


def _cut(texts: list[str | None]) -> tuple[list[str | None], np.ndarray]:
    """Texts in parts of about ``SLICE_CHARS`` characters, and the text of each part.  Parts end at white
    space, which no trigram's middle is, so they have the trigrams of the whole text."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        lo = 0
        while t is not None and len(t) - lo > SLICE_CHARS:
            end = _SPACE.search(t, lo + SLICE_CHARS)
            if end is None:
                break
            parts.append(t[lo:end.start()])
            owner.append(i)
            lo = end.end()
        parts.append(t if t is None or not lo else t[lo:])
        owner.append(i)
    return parts, np.array(owner, np.int64)


def text_vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the trigram vectors of each text, and whether it has a letter."""
    parts, owner = _cut(texts)
    if len(parts) > len(texts):  # a long text: its parts' vectors are added up
        out, has = np.zeros((len(texts), DIMENSION), np.float32), np.zeros(len(texts), bool)
        for s in slices(parts, SLICE_CHARS):
            for i, p in zip(owner[s].tolist(), parts[s], strict=True):
                v, letter = text_vectors([p])
                out[i] += v[0]
                has[i] |= letter[0]
        return out, has
    tri, doc, has = _trigrams(texts)
    out = np.zeros((len(texts), DIMENSION), np.float32)
    if len(tri):
        kind, at = _distinct(tri)
        for lo in range(0, len(kind), 8192):  # bounded memory for large alphabets
            part = (at >= lo) & (at < lo + 8192)
            width = min(8192, len(kind) - lo)
            count = np.bincount(doc[part] * width + at[part] - lo, minlength=len(texts) * width)
            out += count.reshape(len(texts), width).astype(np.float32) @ _vectors(kind[lo:lo + width]).astype(np.float32)
    return out, has


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in ascending order and their prototypes of unit length.  Rows with a
    null text or language teach nothing; repeated rows count as often as they occur.  A long text is
    worked through in parts, so memory follows ``SLICE_CHARS``, not the text."""
    src = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("body")).where(
        "lang is not null and body is not null")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = np.array(b.column("lang").to_pylist(), object), b.column("body").to_pylist()
            for s in slices(texts, SLICE_CHARS):
                for name in sorted(set(langs[s])):
                    parts, _ = _cut([t for t, x in zip(texts[s], langs[s], strict=True) if x == name])
                    for part in slices(parts, SLICE_CHARS):
                        tri, _, _ = _trigrams(parts[part])
                        if not len(tri):
                            continue
                        kind, at = _distinct(tri)
                        count, v = np.bincount(at, minlength=len(kind)).astype(np.float64), np.zeros(DIMENSION)
                        for lo in range(0, len(kind), 8192):
                            v += count[lo:lo + 8192] @ _vectors(kind[lo:lo + 8192]).astype(np.float64)
                        total[name] = total.get(name, 0) + v
        if total:
            names = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([np.rint(total[x]).astype(np.int64).tolist() for x in names], pa.list_(pa.int64()))],
                ["lang", "v"])

    rows = (src.mapInArrow(bundle, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
            .groupBy("lang", "i").agg(F.sum("x").alias("x")).collect())
    names = sorted({r["lang"] for r in rows})
    proto = np.zeros((len(names), DIMENSION))
    for r in rows:
        proto[names.index(r["lang"]), r["i"]] = r["x"]
    return names, proto / np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, doc_id: str = "doc_id", text: str = "text",
            carry: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``carry`` columns, ``lang_pred`` and ``score``, the cosine from 0 to 1.  A null
    text, or one without a letter, is ``und`` with score 0, as is every text without a learned
    language; of equal cosines the first language in order wins."""
    carry = list(carry or [])
    kept = ["doc", *(f"c{i}" for i in range(len(carry)))]
    src = docs.select(F.col(f"`{doc_id}`").alias("doc"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)],
                      F.col(f"`{text}`").alias("body"))
    proto = prototypes.astype(np.float32).T  # languages x dimension: small and of fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs, scores = b.column("body").to_pylist(), [], []
            for s in slices(texts, SLICE_CHARS):
                v, has = text_vectors(texts[s])
                if not names:
                    has = np.zeros(len(has), bool)
                    cos = np.zeros((len(has), 1))
                else:
                    cos = (v @ proto) / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                best = cos.argmax(axis=1)
                langs += [names[k] if ok else UNKNOWN for k, ok in zip(best, has, strict=True)]
                scores.append(np.where(has, np.clip(cos[np.arange(len(best)), best], 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores or [np.zeros(0)]).astype(np.float64))], [*kept, "lang_pred", "score"])

    schema = ", ".join([*(f"{c} {src.schema[c].dataType.simpleString()}" for c in kept), "lang_pred string, score double"])
    return src.mapInArrow(judge, schema).select(
        F.col("doc").alias(doc_id), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "lang_pred", "score")


def identify(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out and predicts all: ``doc_id``, ``held_out``,
    ``lang_pred``, ``score``."""
    marked = docs.select(F.col(f"`{doc_id}`").alias("doc_id_"), F.col(f"`{text}`").alias("text_"),
                         F.col(f"`{lang}`").alias("lang_"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    names, proto = train(marked.where("not held_out"), "text_", "lang_")
    return (predict(marked, names, proto, "doc_id_", "text_", carry=["held_out"])
            .withColumnRenamed("doc_id_", doc_id).select(doc_id, "held_out", "lang_pred", "score"))
