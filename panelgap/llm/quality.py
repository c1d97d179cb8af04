"""Quality rules as a short-circuit cascade (operator 1), in DataFrame functions only.

A rule is a column that says whether a text fails it.  On a sample the cascade
measures what share of the texts each rule rejects and how long it takes, and puts
the rules in the order of rejections per second; then each row goes down one
``CASE`` that stops at the first rule it fails.  The order decides the cost alone:
a text is kept if it fails no rule, in any order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2000
#: Repeats of the sample in one run, and runs of which the median counts.
REPEAT, RUNS = 4, 3


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_chars(word_list: Column) -> Column:
    return F.length(F.array_join(word_list, "")).cast("long")


def n_symbols(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return (F.length(whole) - F.length(F.regexp_replace(whole, f"[{SYMBOLS}]+", ""))).cast("long")


def lines(text: Column) -> Column:
    """The lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(_without(x, GAPS)) > 0)


def n_dup_lines(text: Column) -> Column:
    return _let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(word_list: Column, window: int = WINDOW) -> Column:
    """Words under a window of ``window`` words that occurs twice or more in the text.

    Windows are compared by a 64-bit hash within the text.  Most texts repeat none,
    which the number of distinct hashes tells; the others sort (hash, place) and
    look at the neighbours."""
    zero = F.lit(0).cast("long")

    def hashes(w: Column) -> Column:
        # of each word once, then of the window's eight hashes; get() is in constant time, slice() isn't
        return _let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(window)])))

    def places(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twin = _let(order, lambda s: F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"])
                                              | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1), x + window) - x))
        return F.aggregate(step, zero, lambda a, x: a + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(places(h), covered)).otherwise(zero)

    return F.when(F.size(word_list) > window, _let(hashes(word_list), count)).otherwise(zero)


@dataclass(frozen=True)
class Measures:
    """What the rules look at: the text, its words, and measures that the caller already has as columns."""

    text: Column
    words: Column
    known: dict[str, Column] = field(default_factory=dict)

    def get(self, name: str) -> Column:
        if name in self.known:
            return self.known[name]
        return {"n_words": lambda: F.size(self.words).cast("long"), "word_chars": lambda: word_chars(self.words),
                "n_symbols": lambda: n_symbols(self.text), "n_dup_lines": lambda: n_dup_lines(self.text),
                "n_repeat_words": lambda: n_repeat_words(self.words)}[name]()


@dataclass(frozen=True)
class Rule:
    """``fails(measures)`` is true, false or null (not failed)."""

    name: str
    fails: Callable[[Measures], Column]


def _exclamations(m: Measures) -> Column:
    return F.length(m.text) - F.length(F.replace(m.text, F.lit("!"), F.lit("")))


BASE_RULES = (
    Rule("few_words", lambda m: m.get("n_words") < 20),
    Rule("repeated_passages", lambda m: 100 * m.get("n_repeat_words") > 30 * m.get("n_words")),
)
OWN_RULES = (
    Rule("symbols", lambda m: m.get("n_symbols") > 0.2 * m.get("n_words")),
    Rule("duplicate_lines", lambda m: _let(m.get("n_dup_lines"), lambda n: (n >= 5) & (
        n > 0.5 * F.size(lines(m.text))))),
    Rule("word_length", lambda m: ~m.get("word_chars").between(2 * m.get("n_words"), 16 * m.get("n_words"))),
    Rule("shouting", lambda m: (m.text == F.upper(m.text)) & (m.text != F.lower(m.text))),
    Rule("stutter", lambda m: F.size(F.filter(m.words, lambda x, i: x == F.get(m.words, i - 1)))
         > 0.5 * m.get("n_words")),
    Rule("exclamations", lambda m: _exclamations(m) > 0.5 * m.get("n_words")),
)
RULES = BASE_RULES + OWN_RULES


def order_rules(docs: DataFrame, text: str, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample, best first; a rule that rejects
    nothing there comes last, cheaper ones first.  ``sample_rows`` bounds the sample.

    A rule's cost is the median time of ``RUNS`` runs over the sample, repeated until the rule
    and not the job takes the time, less the median time of a run without a rule."""
    total = docs.count()
    if not total or len(rules) < 2:
        return list(rules)
    m = Measures(F.col("t"), F.col("w"))
    sample = (docs.select(F.col(f"`{text}`").alias("t")).sample(min(1.0, 1.2 * sample_rows / total), seed=7)
              .limit(sample_rows).withColumn("w", words(F.col("t"))).persist())
    try:
        rows = max(1, sample.count())
        shares = sample.agg(*[F.count_if(r.fails(m)).alias(r.name) for r in rules]).first()
        often = sample.select("t", "w", F.explode(F.sequence(F.lit(1), F.lit(REPEAT))).alias("turn"))

        def seconds(fails: Column) -> float:
            times = []
            for _ in range(RUNS):
                began = time.perf_counter()
                often.agg(F.count_if(fails)).collect()
                times.append(time.perf_counter() - began)
            return sorted(times)[RUNS // 2]

        seconds(F.col("turn") < 0)  # warms up
        empty, found = seconds(F.col("turn") < 0), []
        for r in rules:
            # the turn keeps the rule from being worked out once for all repeats of a row
            cost = max(1e-4, seconds(r.fails(m) & (F.col("turn") > 0)) - empty) / REPEAT
            found.append((-shares[r.name] / rows / cost, cost, r.name, r))
    finally:
        sample.unpersist()
    return [r for *_, r in sorted(found, key=lambda x: x[:3])]


def cascade(m: Measures, ordered: list[Rule]) -> Column:
    """Name of the first rule that fails, null if none.  Later rules aren't evaluated then."""
    out = None
    for r in ordered:
        out = F.when(r.fails(m), r.name) if out is None else out.when(r.fails(m), r.name)
    return F.lit(None).cast("string") if out is None else out


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that fail no rule; columns as given.  A null or empty text
    has no words and is rejected; repeated rows are judged alike; an empty table stays
    empty; columns of any name may stand beside ``text``."""
    ordered, t = order_rules(docs, text, rules), F.col(f"`{text}`")
    return docs.where(_let(words(t), lambda w: cascade(Measures(t, w), ordered)).isNull())


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` (under 20 words, or more than
    30 % of them in repeated windows) and ``kept``: not base_failed, and no rule of the
    cascade fails.  A null or empty text has no words and fails; repeated rows are judged
    alike; an empty table gives no rows; other columns are not read."""
    base = {r.name for r in BASE_RULES}
    ordered = order_rules(docs, text, tuple(r for r in rules if r.name not in base))
    t, w = F.col("text_"), F.col("words_")
    whole = docs.select(F.col(f"`{doc_id}`").alias("id_"), F.col(f"`{text}`").alias("text_"))
    stats = whole.withColumn("words_", words(t)).select(
        "id_", "text_", "words_", F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"),
        n_symbols(t).alias("n_symbols"), n_dup_lines(t).alias("n_dup_lines"), n_repeat_words(w).alias("n_repeat_words"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    verdict = cascade(Measures(t, w, {c: F.col(c) for c in names}), ordered).isNull()
    return (stats.withColumn("base_failed", failed)
            .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict))
            .select(F.col("id_").alias(doc_id), *names, "base_failed", "kept"))
