"""Licence scan with a positional index of rare words (operator 12).

Templates of licence notices are indexed by word and position.  For each file the words
that occur in templates are ranked by their inverse document frequency in the corpus; the
rarest ones of a template are looked up, and their places in the file and in the template
are intersected by relative position.  An alignment on which enough of them agree is
verified: the template's mandatory key phrases must stand in it word for word, and enough
of the template's words, weighted by rarity, must be in place.  A single phrase is a
template without tolerance, so all its places are found the same way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import PIECE

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Words of a template that a file's lookup starts from, its rarest ones.
ANCHORS = 6
#: Share of the looked-up words that must agree on an alignment, and of the template's weight in place.
AGREE, COVERAGE = 0.5, 0.8
#: Words that may be inserted or left out between two words of a template.
SLACK = 4

# ---- fixed values: phrases with their labels; notices with their labels and key phrases
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = [
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    ("agpl", "licensed under the GNU Affero General Public License", ("gnu affero general public license",)),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
     ("permission is hereby granted", "free of charge", "without restriction")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met",
     ("redistribution and use in source and binary forms", "with or without modification")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies",
     ("permission to use", "with or without fee", "hereby granted")),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
    ("cc-by-4.0", "licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "licensed under CC BY-ND 4.0", ("cc by nd 4 0",)),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work", ("waived all copyright", "neighboring rights")),
]
# ---- end of fixed values


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in UTF-8, A-Z lower-cased, piece by piece; pieces end between two words."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    lo = 0
    while lo < len(raw):
        cut = _NO_WORD.search(raw, min(len(raw), lo + PIECE))
        hi = cut.start() if cut else len(raw)
        yield _WORD.findall(raw, lo, hi)
        lo = hi + 1


def split_words(text: str) -> list[bytes]:
    return [w for part in word_pieces(text) for w in part]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]
    slack: int = SLACK
    agree: float = AGREE
    coverage: float = COVERAGE


def notices() -> list[Template]:
    return [Template(*n) for n in NOTICES]


def phrases() -> list[Template]:
    """The phrases: every word must stand in its place."""
    return [Template(label, text, (text,), 0, 1.0, 1.0) for text, label in PHRASES.items()]


class PositionalIndex:
    """Postings of template words: word id -> template -> positions."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.ids: dict[bytes, int] = {}
        for t in templates:
            for w in split_words(t.text):
                self.ids.setdefault(w, len(self.ids))
            for k in t.keys:
                for w in split_words(k):
                    self.ids.setdefault(w, len(self.ids))
        self.words = [np.array([self.ids[w] for w in split_words(t.text)], np.int64) for t in templates]
        self.keys = [[np.array([self.ids[w] for w in split_words(k)], np.int64) for k in t.keys] for t in templates]
        self.needed = [frozenset(int(w) for k in keys for w in k) for keys in self.keys]
        #: Of each template: positions by word.
        self.postings: list[dict[int, np.ndarray]] = [{int(w): np.flatnonzero(ws == w) for w in np.unique(ws)} for ws in self.words]

    def read(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words of a text, and place and id of those in the index."""
        n, places, ids, get = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], self.ids.get
        for part in word_pieces(text):
            here = np.fromiter((get(w, -1) for w in part), np.int32, len(part))
            known = np.flatnonzero(here >= 0)
            places.append(known + n)
            ids.append(here[known].astype(np.int64))
            n += len(part)
        return n, np.concatenate(places), np.concatenate(ids)


def _near(values: np.ndarray, sorted_set: np.ndarray, slack: int) -> np.ndarray:
    """Which values have a member of an ascending set within ``slack``."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values - slack)
    inside = at < len(sorted_set)
    out = np.zeros(len(values), bool)
    out[inside] = sorted_set[at[inside]] <= values[inside] + slack
    return out


class Scanner:
    """Finds the templates of an index in files, given the rarity of its words."""

    def __init__(self, index: PositionalIndex, idf: np.ndarray):
        self.index, self.idf = index, idf

    def _alignments(self, t: int, own: dict[int, np.ndarray]) -> np.ndarray:
        """Shifts between file and template on which enough of the rarest words agree."""
        posted, slack = self.index.postings[t], self.index.templates[t].slack
        rare = sorted((w for w in posted if w in own), key=lambda w: (-self.idf[w], w))
        if self.index.templates[t].agree < 1:
            rare = rare[:ANCHORS]
        elif len(rare) < len(posted):
            return np.zeros(0, np.int64)
        shifts = [np.unique((own[w][:, None] - posted[w][None, :]).ravel()) for w in rare]
        need = max(1, int(np.ceil(self.index.templates[t].agree * len(rare))))
        # any agreeing set of `need` words has one among the first words, up to len - need + 1 of them
        first = np.unique(np.concatenate(shifts[:len(rare) - need + 1]))
        votes = np.zeros(len(first), np.int64)
        for s in shifts:
            votes += _near(first, s, slack)
        return first[votes >= need]

    def _places(self, key: np.ndarray, own: dict[int, np.ndarray]) -> np.ndarray:
        """Starts of a phrase in the file, from its rarest word on."""
        order = sorted(range(len(key)), key=lambda i: (-self.idf[key[i]], i))
        starts = own[int(key[order[0]])] - order[0]
        for i in order[1:]:
            starts = starts[np.isin(starts + i, own[int(key[i])], assume_unique=True)]
        return starts

    def _verified(self, t: int, own: dict[int, np.ndarray]) -> list[tuple[int, int, float]]:
        """(start, end, share in place) of the alignments of a template that stand the check."""
        template, words = self.index.templates[t], self.index.words[t]
        shift = self._alignments(t, own)
        for key in self.index.keys[t] if len(shift) else ():
            starts = self._places(key, own)
            at = np.searchsorted(starts, shift - template.slack)
            inside = at < len(starts)
            inside[inside] = starts[at[inside]] + len(key) <= shift[inside] + len(words) + template.slack
            shift = shift[inside]
        if not len(shift):
            return []
        weight, share = self.idf[words], np.zeros(len(shift))
        for q, w in enumerate(words):
            if int(w) in own:
                share += weight[q] * _near(shift + q, own[int(w)], template.slack)
        share = share / weight.sum()
        good = share >= template.coverage - 1e-9
        out: list[tuple[int, int, float]] = []
        for s, x in zip(shift[good].tolist(), share[good].tolist(), strict=True):
            if template.slack and out and s - out[-1][0] <= 2 * template.slack:  # shifts of one place: the best
                if x > out[-1][2]:
                    out[-1] = (s, s + len(words), min(1.0, x))
            else:
                out.append((s, s + len(words), min(1.0, x)))
        return out

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int, int, float]]]:
        """Number of words, and (template, start, end, share in place) of every find."""
        n, places, ids = self.index.read(text)
        if not len(ids):
            return n, []
        order = np.argsort(ids, kind="stable")
        word, at = np.unique(ids[order], return_index=True)
        own = dict(zip(word.tolist(), np.split(places[order], at[1:]), strict=True))
        present = own.keys()
        return n, [(t, *hit) for t, needed in enumerate(self.index.needed) if needed <= present
                   for hit in self._verified(t, own)]


def inverse_frequencies(docs: DataFrame, index: PositionalIndex, text: str = "text") -> np.ndarray:
    """``log((1 + documents) / (1 + documents with the word)) + 1`` of every word of the index, over
    all rows.  Only these words, a bounded set, are counted and come to the driver."""
    names = list(index.ids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for t in b.column("body").to_pylist():
                own: set[int] = set()
                for part in word_pieces(t):
                    own |= {index.ids[w] for w in index.ids.keys() & set(part)}
                seen.update(own)
                seen[-1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int32()), pa.array(seen.values(), pa.int64())],
                                             ["word", "n"])

    rows = (docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(count, "word int, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    n = {r["word"]: r["n"] for r in rows}
    return np.log((1 + n.get(-1, 0)) / (1 + np.array([n.get(i, 0) for i in range(len(names))]))) + 1


def scan_licenses(docs: DataFrame, scanner: Scanner, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words`` and ``found``, a list of ``template`` (its
    place in the index), ``label``, ``first_word``, ``last_word`` and ``share`` (weight in place, 0 to 1), by
    template and place.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.  A
    null or empty text has no words and no finds; a text of any length is read whole, in
    pieces, and only its words of the index are held.  Repeated rows give repeated rows, an
    empty table none; other columns are not read.
    """
    src = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("body"))
    found = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("first_word", pa.int64()),
                                ("last_word", pa.int64()), ("share", pa.float64())]))
    labels = [t.label for t in scanner.index.templates]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, hits = [], []
            for t in b.column("body").to_pylist():
                n, own = scanner.find(t)
                sizes.append(n)
                hits.append([{"template": k, "label": labels[k], "first_word": lo, "last_word": hi - 1, "share": x}
                             for k, lo, hi, x in own])
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(sizes, pa.int64()), pa.array(hits, found)],
                                             ["doc", "n_words", "found"])

    kind = src.schema["doc"].dataType.simpleString()
    return (src.mapInArrow(find, f"doc {kind}, n_words long, found array<struct<template:int,label:string,first_word:long,"
                                 "last_word:long,share:double>>").withColumnRenamed("doc", doc_id))
