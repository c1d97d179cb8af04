"""Words of whole texts as 64-bit hashes, computed batch-wise with numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 these
bytes never occur inside a multi-byte character, so the byte rule equals the
character rule.  Texts of any length are processed in pieces cut at white
space, so the working memory is a few times ``PIECE`` bytes plus eight bytes a
word.
"""

from __future__ import annotations

import re

import numpy as np

PIECE = 1 << 20
_BREAK = re.compile(rb"[\x20\x09-\x0d]")
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C1B  # odd: invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 4096)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_bytes(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of one piece."""
    b = np.frombuffer(piece, np.uint8)
    gap = np.ones(len(b) + 2, np.int8)
    gap[1:-1] = _IS_BREAK[b]
    edge = np.flatnonzero(np.diff(gap))
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[b] * _power_table(_BASE, len(b)), out=total[1:])
    h = (total[end] - total[start]) * _power_table(_INVERSE, len(b) + 1)[start]
    return start, mix(h + (end - start).astype(np.uint64))


def _pieces(texts: list[bytes]):
    """(bytes, (offset, text index) of the texts in it, None), or (part of one long text, None,
    its index); about PIECE bytes each, cut at white space."""
    held, at, size = [], [], 0
    for i, t in enumerate(texts):
        if size and size + len(t) > PIECE:
            yield b" ".join(held), np.array(at), None
            held, at, size = [], [], 0
        if len(t) <= PIECE:
            held.append(t)
            at.append((size, i))
            size += len(t) + 1
            continue
        lo = 0
        while lo < len(t):
            cut = _BREAK.search(t, min(len(t), lo + PIECE))
            hi = cut.start() if cut else len(t)
            yield t[lo:hi], None, i
            lo = hi + 1
    if held:
        yield b" ".join(held), np.array(at), None


def word_hashes(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the document index of each
    word.  ``lower`` lower-cases A-Z first.  A null text has no words."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    if lower:
        raw = [t.lower() for t in raw]
    hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for piece, at, one in _pieces(raw):
        start, h = _hash_bytes(piece)
        hashes.append(h)
        docs.append(np.full(len(h), one, np.int64) if at is None
                    else at[np.searchsorted(at[:, 0], start, "right") - 1, 1])
    return np.concatenate(hashes), np.concatenate(docs)


def ngrams(words: np.ndarray, docs: np.ndarray, n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each position on, and whether the n words lie in
    one document.  Both have ``len(words) - n + 1`` entries (none if shorter)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    step = np.uint64((_BASE * (2 * seed + 1)) & ((1 << 64) - 1))
    acc = words[:size].copy()
    for j in range(1, n):
        acc *= step
        acc += words[j:j + size]
    return mix(acc + np.uint64(seed)), docs[:size] == docs[n - 1:]


def slices(texts: list[str | None], size: int = 4 * PIECE) -> list[slice]:
    """Runs of neighbouring texts of about ``size`` characters, or one longer text."""
    out, lo, held = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and held + n > size:
            out.append(slice(lo, i))
            lo, held = i, 0
        held += n
    if lo < len(texts):
        out.append(slice(lo, len(texts)))
    return out
