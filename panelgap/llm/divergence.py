"""Source divergence audit by pair tasks (operator 11).

Terms are counted per group, a (language, source) pair; a language keeps the terms that
enough of its documents hold.  Each group becomes sorted arrays of (term id, count).  For
every unordered pair of groups of a language the two arrays are co-grouped and merged: a
galloping intersection finds the common terms, and overlaps, one-sided terms and terms
that both lack are priced, the last by their number alone.  Arrays are cut into blocks of
terms by a hash, so a task holds two blocks, however large the vocabulary is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .words import PIECE

#: A term in UTF-8 after A-Z are lower-cased: letters and all bytes of characters beyond ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
#: Distinct (group, term) entries that a counting task holds before it sends them on.
HELD_ENTRIES = 400_000
#: Terms of a language to a block, about.
BLOCK_TERMS = 1 << 16
#: Ids of the shorter array that are searched together in one stretch of the longer one.
RUN = 128
SCALE_STEPS = 3  # the scale 10**9 is applied in three steps of 1000, each exact in 64 bits


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece; pieces end between two terms."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    lo = 0
    while lo < len(raw):
        cut = _NO_TERM.search(raw, min(len(raw), lo + PIECE))
        hi = cut.start() if cut else len(raw)
        yield _TERM.findall(raw, lo, hi)
        lo = hi + 1


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, merged over the documents of a task."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def flush() -> pa.RecordBatch:
        sizes = [len(n) for n, _ in held.values()]
        group, size = pa.array(np.repeat(np.arange(len(sizes)), sizes)), sum(sizes)
        of = [pa.array([g[i] for g in held], pa.string()).take(group) for i in (0, 1)]
        words = pa.array(chain.from_iterable(n for n, _ in held.values()), pa.binary(), size=size)
        counts = np.fromiter(chain.from_iterable(n.values() for n, _ in held.values()), np.int64, size)
        docs = np.fromiter(chain.from_iterable(map(df.__getitem__, n) for n, df in held.values()), np.int64, size)
        held.clear()
        return pa.RecordBatch.from_arrays([*of, words.cast(pa.string()), pa.array(counts), pa.array(docs)],
                                          ["lang", "source", "term", "n", "df"])

    entries = 0
    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "body")), strict=True):
            n, df = held.setdefault((lang, source), (Counter(), Counter()))
            entries -= len(n)
            own: set[bytes] = set()
            for part in terms(text):
                n.update(part)
                own.update(part)
            df.update(own)
            entries += len(n)
            if entries > HELD_ENTRIES:
                yield flush()
                entries = 0
    if held:
        yield flush()


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def scaled_share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * vocabulary)), exact while the divisor is
    below 9 * 10**15; null where the vocabulary is empty."""
    whole = F.when(vocabulary > 0, total + 2 * vocabulary)
    rest, out = count + 2, F.lit(0).cast("long")
    for step in range(SCALE_STEPS + 1):
        if step:
            rest, out = rest * 1000, out * 1000
        out, rest = out + _div(rest, whole), rest % whole
    return out + 1


def _shares(count: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    whole, rest = np.int64(total + 2 * vocabulary), count.astype(np.int64) + 2
    out, rest = rest // whole, rest % whole
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def price(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Place in ``long`` of every id of ``short``, both ascending: steps double from where the
    run before ended until they pass the next run, which is then searched in that stretch."""
    at, lo = np.empty(len(short), np.int64), 0
    for i in range(0, len(short), RUN):
        run, step = short[i:i + RUN], RUN
        while lo + step < len(long) and long[lo + step] < run[-1]:
            step *= 2
        at[i:i + RUN] = lo + np.searchsorted(long[lo:lo + step + 1], run)
        lo = int(at[i + len(run) - 1])
    return at


def merge(a_ids: np.ndarray, a_counts: np.ndarray, a_total: int, b_ids: np.ndarray, b_counts: np.ndarray, b_total: int,
          vocabulary: int) -> tuple[int, int]:
    """Price of all terms that at least one of two groups holds, and their number."""
    if len(a_ids) > len(b_ids):  # the price is the same both ways
        return merge(b_ids, b_counts, b_total, a_ids, a_counts, a_total, vocabulary)
    at = gallop(a_ids, b_ids)
    common = np.zeros(len(a_ids), bool)
    inside = at < len(b_ids)
    common[inside] = b_ids[at[inside]] == a_ids[inside]
    other = np.zeros(len(a_ids), np.int64)
    other[common] = b_counts[at[common]]
    alone = np.ones(len(b_ids), bool)
    alone[at[common]] = False
    p = np.concatenate([_shares(a_counts, a_total, vocabulary), _shares(np.zeros(int(alone.sum()), np.int64), a_total, vocabulary)])
    q = np.concatenate([_shares(other, b_total, vocabulary), _shares(b_counts[alone], b_total, vocabulary)])
    return int(((p - q) * (p - q) // (p + q)).sum()), len(p)


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block of a pair: each side has one row, or none where the group lacks the block."""
    some = left if left.num_rows else right.rename_columns(left.column_names)
    of = {c: some.column(c)[0].as_py() for c in ("lang", "a", "b", "n_a", "n_b", "v")}
    sides = []
    for t in (left, right):
        for c in t.column_names[-2:]:
            sides.append(np.asarray(t.column(c)[0].values if t.num_rows else [], np.int64))
    value, held = merge(sides[0], sides[1], of["n_a"], sides[2], sides[3], of["n_b"], of["v"])
    return pa.table({"lang": [of["lang"]], "a": [of["a"]], "b": [of["b"]],
                     "value": pa.array([value], pa.int64()), "held": pa.array([held], pa.int64())})


def divergence_audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                     min_docs: int = 10, top_terms: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """How far the sources of each language lie apart: ``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language as ``item``, with the summed price of all
    kept terms.  Part ``term``: the ``top_terms`` kept terms that the group holds oftener than
    its language, by price.  The price of a term is ``floor((p - q)**2 / (p + q))`` of its
    scaled, smoothed shares.  Ranks ascend from 1, values descending, items in UTF-8 order.

    A term is a run of letters and characters beyond ASCII, A-Z lower-cased; a language keeps
    those in at least ``min_docs`` of its rows.  Null texts, languages and sources read as empty
    strings; repeated rows count as often as they occur; a group without terms still has its
    pairs; a language with one source has none; an empty table gives no rows.  Other columns
    are not read.  Rows between tasks are (group, term) counts and, for each pair, the arrays of
    its groups: their number follows the vocabulary and the groups, not the texts.
    """
    ensure_checkpoint_dir(docs.sparkSession)

    def read(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    src = docs.select(read(lang).alias("lang"), read(source).alias("source"), F.col(f"`{text}`").alias("body"))
    same_term = Window.partitionBy("lang", "term")
    counted = (src.mapInArrow(_count_terms, "lang string, source string, term string, n long, df long")
               .repartition("lang", "source", "term")  # merged in the task already: Spark need not try once more
               .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    # a term's id is its first row's: unique, and the same for all sources, as they meet in one partition
    kept = (counted.repartition("lang", "term").withColumn("row", F.monotonically_increasing_id())
            .select("lang", "source", "term", "n", "row", F.sum("df").over(same_term).alias("df"),
                    F.sum("n").over(same_term).alias("n_lang"), F.min("row").over(same_term).alias("id"))
            .where(F.col("df") >= min_docs).drop("df").checkpoint())
    langs = kept.groupBy("lang").agg(F.count(F.when(F.col("row") == F.col("id"), 1)).alias("v"), F.sum("n").alias("total"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    zero = F.lit(0).cast("long")
    groups = (src.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("n_group", zero).alias("n_group"), F.coalesce("v", zero).alias("v"),
                      F.coalesce("total", zero).alias("total")).checkpoint())

    held = kept.join(groups, ["lang", "source"])
    p = scaled_share(F.col("n"), F.col("n_group"), F.col("v"))
    q = scaled_share(F.col("n_lang"), F.col("total"), F.col("v"))
    own_terms = (held.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
                 .where(F.col("p") > F.col("q"))
                 .select("lang", "source", F.lit("term").alias("part"), "item", price(F.col("p"), F.col("q")).alias("value")))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    top = own_terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / F.lit(block_terms)))
    arrays = (held.groupBy("lang", "source", block.alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("e"))
              .select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")))
    other = groups.select("lang", F.col("source").alias("b"), F.col("n_group").alias("n_b"))
    pairs = (groups.select("lang", F.col("source").alias("a"), F.col("n_group").alias("n_a"), "v").join(other, "lang")
             .where(F.col("a") < F.col("b")))
    key = ["lang", "a", "b", "block"]

    def side(own: str, prefix: str) -> DataFrame:
        return (pairs.join(arrays.withColumnRenamed("source", own), ["lang", own])
                .select(*[F.col(c).alias(prefix + c) for c in (*key, "n_a", "n_b", "v", "ids", "counts")]))

    left, right = side("a", ""), side("b", "of_")
    merged = (left.groupBy(*key).cogroup(right.groupBy(*(f"of_{c}" for c in key)))
              .applyInArrow(_pair_task, "lang string, a string, b string, value long, held long")
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("held").alias("held")))
    lacking = price(scaled_share(zero, F.col("n_a"), F.col("v")), scaled_share(zero, F.col("n_b"), F.col("v")))
    priced = (pairs.join(merged, ["lang", "a", "b"], "left")
              .withColumn("value", F.when(F.col("v") == 0, zero).otherwise(
                  F.coalesce("value", zero) + (F.col("v") - F.coalesce("held", zero)) * lacking)))
    both_ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    apart = (priced.select("lang", both_ways.alias("w"), "value")
             .select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
             .withColumn("rank", F.row_number().over(best)))
    return apart.unionByName(top)
