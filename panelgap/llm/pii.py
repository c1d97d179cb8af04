"""Personal data by boosted candidates (operator 3).

Generators of high recall propose overlapping spans: the strict formats, which always
count, and loose ones (digit groups without a plus, spelt-out mail addresses, dotted
numbers).  Boosted trees score each loose candidate from features of its format and
its context; a threshold per kind, calibrated on candidates kept apart, selects the
spans to add.  The trees learn from the candidates of the whole corpus: loosely written
variants of strict spans, and of invented ones set into its texts, are positive,
candidates that break a format rule and damaged variants are negative.  A candidate that
breaks none may be personal data and has no label.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
#: One text of so many gets invented spans, and in a small corpus about so many texts get them.
HOST_EVERY, INVENTED_DOCS = 100, 500
#: Rows of the table of candidates in a partition, at least; steps of the thresholds.
TABLE_ROWS, STEPS = 50_000, 10_000
PRECISION = 0.99
CONTEXT = 32

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE_MAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:\[at\]|\(at\)) ?| at (?=[A-Za-z0-9-]++(?: ?\[dot\]| ?\(dot\)| dot )))"
                         r"[A-Za-z0-9-]++(?:(?: ?(?:\[dot\]|\(dot\)) ?| dot |\.)[A-Za-z0-9-]++)+")
_LOOSE_DIGITS = re.compile(r"\(?[0-9](?:[ ().\-/]{0,3}[0-9]){6,}+")
_LOOSE_IP = re.compile(r"[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9])")
_WORDS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
          "card": ("card", "visa", "pay", "credit"), "phone": ("tel", "phone", "call", "fax", "mobile")}


def _luhn_sum(digits: str) -> int:
    """Luhn's weighted sum; a multiple of ten if the check digit is right."""
    d = [int(c) for c in reversed(digits)]
    return sum(d[0::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])


def strict_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the strict formats by kind, left to right; matches that fail a check are dropped."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    end = 0
    for m in _AT.finditer(text) if "@" in text else ():
        lo = m.start()
        while lo > end and _LOCAL.match(text, lo - 1):
            lo -= 1
        if lo < m.start():
            out["email"].append((lo, m.end()))
            end = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and _luhn_sum(digits) % 10 == 0:
                out["card"].append(m.span())
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out["phone"].append(m.span())
    return out


def loose_candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the loose formats; kinds and spans may overlap."""
    out = []
    if "at" in text:
        out += [("email", *m.span()) for m in _LOOSE_MAIL.finditer(text)]
    out += [("ip", *m.span()) for m in _LOOSE_IP.finditer(text)]
    for m in _LOOSE_DIGITS.finditer(text):
        n = sum(c.isdigit() for c in m.group())
        out += [("card" if n >= 13 else "phone", *m.span())]
    return out


def breaks_rule(text: str, kind: str, lo: int, hi: int) -> bool:
    """Whether the format alone rules a loose candidate out."""
    span = text[lo:hi]
    if kind == "email":
        name, host = re.split(r" ?(?:\[at\]|\(at\)) ?| at ", span, maxsplit=1)
        labels = re.split(r" ?(?:\[dot\]|\(dot\)) ?| dot |\.", host)
        return ("." in (name[0], name[-1]) or len(labels[-1]) < 2 or not labels[-1].isalpha()
                or any("-" in (x[:1], x[-1:]) for x in labels))
    if text[max(0, lo - 1):lo].isalnum() or text[hi:hi + 1].isalnum():
        return True
    groups = re.findall("[0-9]+", span)
    sizes, digits = [len(g) for g in groups], "".join(groups)
    if kind == "ip":
        longer = re.search("[0-9][.,]$", text[max(0, lo - 2):lo]) or re.match("[.,][0-9]", text[hi:hi + 2])
        return "," in span or bool(longer) or any(int(g) > 255 for g in groups)
    if kind == "card":  # one run, or fours with a shorter last group
        return (not 16 <= len(digits) <= 19 or _luhn_sum(digits) % 10 != 0
                or len(sizes) > 1 and (any(n != 4 for n in sizes[:-1]) or sizes[-1] > 4))
    date = sizes[:3] in ([4, 2, 2], [2, 2, 4]) or sizes == [4, 4] and all(g[:2] in ("19", "20") for g in groups)
    thousands = set(sizes[1:]) == {3} and sizes[0] <= 3 and not re.search(r"[^0-9.]", span)
    return len(sizes) == 1 or len(sizes) > 5 or min(sizes[1:]) == 1 or date or thousands or (")" in span and "(" not in span)


def features(text: str, kind: str, lo: int, hi: int) -> list[float]:
    """Format and context of one candidate as numbers."""
    span, before, after = text[lo:hi], text[max(0, lo - CONTEXT):lo].lower(), text[hi:hi + 1]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    return [*(float(kind == k) for k in KINDS), hi - lo, len(digits), sum(c.isalpha() for c in span), len(groups),
            max(sizes), min(sizes), sizes[0], sizes[-1], span.count("."), span.count("-"), span.count(" "),
            span.count("(") - span.count(")"), span.count("("), span.count("@"), span.count("/"), span.count(","),
            float(bool(digits) and _luhn_sum(digits) % 10 == 0), float(max((int(g[:9]) for g in groups), default=0) <= 255),
            float(len(set(digits)) > 2), float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] == "+"),
            float(any(w in before for w in _WORDS[kind])), float(before.rstrip()[-1:] in (":", "=")), float(span[-2:].isalpha())]


@dataclass
class BoostedTrees:
    """Gradient boosting of depth-two trees on binned features, for the logistic loss."""

    rounds: int = 64
    rate: float = 0.3
    bins: int = 16
    bias: float = 0.0
    cuts: list = field(default_factory=list)  # of each feature
    trees: list = field(default_factory=list)  # (feature, bin, ((feature, bin, low, high), (... )))

    def _split(self, g: np.ndarray, h: np.ndarray):
        """The split with the largest gain, and the values of its sides: ``g`` and ``h`` are the sums of residuals and
        of weights by feature and bin."""
        total, mass = g[0].sum(), h[0].sum()
        best = (0.0, 0, 0, total / (mass + 1), total / (mass + 1))
        for j, cuts in enumerate(self.cuts):
            low, light = np.cumsum(g[j]), np.cumsum(h[j])
            for b in range(len(cuts)):
                gain = low[b] ** 2 / (light[b] + 1) + (total - low[b]) ** 2 / (mass - light[b] + 1) - total * total / (mass + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, j, b, low[b] / (light[b] + 1), (total - low[b]) / (mass - light[b] + 1))
        return best

    def binned(self, x: np.ndarray) -> np.ndarray:
        """The bin of each value: how many cuts are below it."""
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1).astype(np.int32)

    def _sums(self, table: DataFrame, root: tuple[int, int] | None, several: bool) -> np.ndarray:
        """Sums of residuals and of weights by side of the ``root`` split (or over all), feature and bin, of
        every row of ``table(x, n, y)``: binned features, number of rows alike, and of positive ones.  ``several``:
        the table has more than one partition."""
        bias, trees, rate, wide = self.bias, list(self.trees), self.rate, self.bins + 1

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for b in batches:
                n, y = (b.column(c).to_numpy() for c in ("n", "y"))
                x = _matrix(b.column("x"))
                p = 1 / (1 + np.exp(-_score(bias, rate, trees, x)))
                side = np.zeros(len(x), np.int64) if root is None else (x[:, root[0]] > root[1]).astype(np.int64)
                at = (side[:, None] * x.shape[1] + np.arange(x.shape[1])) * wide + x
                size = 2 * x.shape[1] * wide
                sums = np.stack([np.bincount(at.ravel(), np.repeat(v, x.shape[1]), size) for v in (y - n * p, n * p * (1 - p))])
                out = sums if out is None else out + sums
            if out is not None:
                k = np.flatnonzero(out[1])
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(out[0][k]), pa.array(out[1][k])], ["k", "g", "h"])

        sums = table.mapInArrow(add, "k long, g double, h double")
        if several:
            sums = sums.groupBy("k").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        found, out = sums.toArrow(), np.zeros((2, 2 * len(self.cuts) * wide))
        out[:, found["k"].to_numpy()] = found["g"].to_numpy(), found["h"].to_numpy()
        return out.reshape(2, 2, len(self.cuts), wide)

    def fit(self, table: DataFrame, cuts: list[np.ndarray]) -> BoostedTrees:
        """Fits on all rows of ``table(x, n, y)``, features in the bins of ``cuts``: two jobs a round add the sums of every
        bin up, which is all that passes the driver.  With one class there is no tree and the bias alone decides."""
        self.cuts = cuts
        n, y = table.agg(F.sum("n"), F.sum("y")).first()
        if not n:
            return self
        mean = np.clip(y / n, 1e-3, 1 - 1e-3)
        self.bias = float(np.log(mean / (1 - mean)))
        several = table.rdd.getNumPartitions() > 1
        for _ in range(self.rounds):
            sums = self._sums(table, None, several)
            gain, j, b, *_ = self._split(sums[0, 0], sums[1, 0])
            if gain <= 0:
                break
            sums = self._sums(table, (j, b), several)
            self.trees.append((j, b, [self._split(sums[0, s], sums[1, s])[1:] for s in (0, 1)]))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.predict_binned(self.binned(x)) if self.trees else np.full(len(x), 1 / (1 + np.exp(-self.bias)))

    def predict_binned(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_score(self.bias, self.rate, self.trees, x)))


def _score(bias: float, rate: float, trees: list, x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), bias)
    for j, b, sides in trees:
        out = [np.where(x[:, k] <= cut, low, high) for k, cut, low, high in sides]
        score += rate * np.where(x[:, j] <= b, out[0], out[1])
    return score


def _matrix(rows: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return rows.flatten().to_numpy().reshape(len(rows), -1)


def _pick(rng: np.random.Generator, *options):
    return options[int(rng.integers(len(options)))]


def _grouped(digits: str, sizes: list[int], seps: list[str]) -> str:
    """Digits in groups of these sizes (the last takes the rest) with the separators between them, the last repeated."""
    out, lo = [], 0
    for n in sizes:
        out.append(digits[lo:lo + n])
        lo += n
    out = [x for x in [*out, digits[lo:]] if x]
    return "".join(x + (seps[min(i, len(seps) - 1)] if i < len(out) - 1 else "") for i, x in enumerate(out))


def _variants(kind: str, span: str, rng: np.random.Generator) -> list[tuple[str, int]]:
    """Loosely written forms of a strict span (1) and damaged ones (0), drawn anew for each span."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        name, _, host = span.partition("@")
        spelt = [_pick(rng, "(at)", "[at]", " (at) ", " [at] ").join([name, host.replace(".", _pick(rng, ".", " dot ", "[dot]", " (dot) "))]),
                 f"{name} at {host.replace('.', _pick(rng, ' dot ', '[dot]', ' [dot] ', '(dot)'))}"]
        return [*((s, 1) for s in spelt), (f"{name}. at {host.rpartition('.')[0].replace('.', ' dot ')} dot {rng.integers(100)}", 0)]
    if kind == "ip":
        parts = span.split(".")
        mixed = "".join(p + _pick(rng, " . ", ". ", " .", ".") for p in parts[:2]) + parts[2] + _pick(rng, " . ", ". ", " .") + parts[3]
        return [(_pick(rng, " . ", ". ", " .").join(parts), 1), (mixed, 1),
                (f"{int(parts[0]) + 256}{mixed[len(parts[0]):]}"[:18], 0),
                (".".join([str(int(parts[0][:3]) + 256), *parts[1:]])[:15], 0), (_pick(rng, ",", ", ").join(parts), 0)]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + int(rng.integers(1, 10))) % 10)
        seps = ["  ", "--", "- ", ".", "/", " -"]
        return [*((_grouped(digits, [4, 4, 4], [s]), 1) for s in rng.choice(seps, 2, replace=False).tolist()), (wrong, 0),
                *((_grouped(wrong, [4, 4, 4], [s]), 0) for s in (" ", *rng.choice(seps, 2, replace=False).tolist())),
                (_grouped(digits, [3, 5, 2], [_pick(rng, *seps)]), 0)]
    local = digits[-10:]
    one, two = rng.choice(["-", ".", " ", "/", "- ", ". "], 2).tolist()
    return [(f"({local[:3]}){_pick(rng, '', ' ')}{_grouped(local[3:], [3], [_pick(rng, '-', ' ', '.')])}", 1),
            (_grouped(local, [3, 3], [one, two]), 1),
            (_grouped(local, [3, 3], [_pick(rng, "-", ".", " ", "/")]), 1),
            (_grouped(f"00{digits}", [4, 3, 3], [_pick(rng, " ", "-", "/", " ")]), 1), (_grouped(f"0{local}", [_pick(rng, 3, 4, 5)], [_pick(rng, "/", "-", " ")]), 1),
            (local, 0), (_grouped(local[:8], [4, 2], [_pick(rng, "-", "/", ".")]), 0), (_grouped(f"19{local[:6]}", [4, 2], ["-"]), 0),
            (_grouped(local, [1, 3, 3], ["."]), 0)]


def _invented(kind: str, rng: np.random.Generator) -> str:
    """A strict span of the kind that belongs to nobody."""
    def letters(n: int) -> str:
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))

    def numerals(n: int) -> str:
        return "".join(str(int(c)) for c in rng.integers(0, 10, n))

    if kind == "email":
        return f"{letters(5)}{_pick(rng, '', '.', '_')}{letters(4)}{numerals(2)}@{letters(6)}.{_pick(rng, 'com', 'org', 'net', 'de', 'fr')}"
    if kind == "ip":
        return ".".join(str(int(x)) for x in rng.integers(1, 255, 4))
    if kind == "card":
        first = f"{rng.integers(3, 7)}{numerals(14)}"
        return first + str(-_luhn_sum(first + "0") % 10)
    return f"+{rng.integers(1, 99)}{rng.integers(2, 10)}{numerals(9)}"


def labelled_candidates(text: str, seed: int, invent: bool = False) -> list[tuple[list[float], int]]:
    """Training rows of one text: features and label.  With ``invent``, one invented span of each kind
    stands at a space of the text too, so that kinds which the corpus only has in loose forms are learnt."""
    rng, strict, out = np.random.default_rng(seed), strict_spans(text), []
    taken = [s for spans in strict.values() for s in spans]
    for kind, lo, hi in loose_candidates(text):
        if not any(lo < b and a < hi for a, b in taken) and breaks_rule(text, kind, lo, hi):
            out.append((features(text, kind, lo, hi), 0))
    places = [(kind, a, b, text[a:b]) for kind, spans in strict.items() for a, b in spans]
    spaces = [m.start() for m in re.finditer(r"(?<=[^\W\d_]) (?=[^\W\d_])", text)] if invent else []
    if spaces:
        places += [(kind, x + 1, x + 1, _invented(kind, rng)) for kind in KINDS for x in [_pick(rng, *spaces)]]
    for kind, a, b, span in places:
        gap = " " if a == b else ""
        for form, label in _variants(kind, span, rng):
            changed = text[max(0, a - CONTEXT):a] + form + gap + text[b:b + CONTEXT]
            lo = min(a, CONTEXT)
            out += [(features(changed, k, x, y), label) for k, x, y in loose_candidates(changed)
                    if x < lo + len(form) and lo < y and (k == kind or not label) and (not label or (x, y) == (lo, lo + len(form)))]
    return out


@dataclass
class Detector:
    trees: BoostedTrees
    threshold: dict[str, float]

    def spans(self, text: str) -> tuple[dict, dict]:
        """Strict spans and the added ones by kind; added spans overlap no other."""
        strict, added = strict_spans(text), {k: [] for k in KINDS}
        taken = [s for spans in strict.values() for s in spans]
        loose = [c for c in loose_candidates(text) if not any(c[1] < b and a < c[2] for a, b in taken)]
        if loose:
            p = self.trees.predict(np.array([features(text, *c) for c in loose], float))
            for i in np.argsort(-p, kind="stable"):
                kind, lo, hi = loose[i]
                if p[i] >= self.threshold[kind] and not any(lo < b and a < hi for a, b in taken):
                    added[kind].append((lo, hi))
                    taken.append((lo, hi))
        return strict, {k: sorted(v) for k, v in added.items()}


def fit(docs: DataFrame, text: str = "text") -> Detector:
    """Fits the trees on the labelled candidates of every document but a quarter, by a hash of the
    text, and sets the thresholds on all candidates of that quarter, which the trees didn't
    see: the lowest, in steps of 1 / ``STEPS``, at which ``PRECISION`` of what a kind selects is right, else
    nothing is added.  Candidates with the same features are one row with their number, and then
    those in the same bins; the table of them stays in Spark.  Where the learning part has
    no candidates or only one label, as with an empty table or one text repeated, nothing is added
    either.  Null texts are left out, other columns not read."""
    ensure_checkpoint_dir(docs.sparkSession)
    # invented spans in about one text of HOST_EVERY, in a small corpus in about INVENTED_DOCS texts, or in all of fewer
    every = max(1, min(HOST_EVERY, docs.count() // INVENTED_DOCS))
    src = docs.select(F.col(f"`{text}`").alias("body")).where("body is not null").select(
        "body", F.xxhash64("body", F.monotonically_increasing_id()).alias("row"),
        (F.pmod(F.xxhash64("body"), F.lit(4)) == 3).alias("held"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            alike: Counter = Counter()
            for t, row, held in zip(*(b.column(c).to_pylist() for c in ("body", "row", "held")), strict=True):
                alike.update((held, y, tuple(x)) for x, y in labelled_candidates(t, row % (1 << 32), (row >> 32) % every == 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in alike], pa.bool_()), pa.array([list(k[2]) for k in alike], pa.list_(pa.float64())),
                 pa.array(list(alike.values()), pa.int64()), pa.array([k[1] * n for k, n in alike.items()], pa.int64())],
                ["held", "x", "n", "y"])

    counts = [F.sum(c).alias(c) for c in ("n", "y")]
    found = (src.mapInArrow(label, "held boolean, x array<double>, n long, y long")
             .groupBy("held", "x").agg(*counts).checkpoint())
    learnt = found.where("not held")
    n, y, width = learnt.agg(F.sum("n"), F.sum("y"), F.max(F.size("x"))).first()
    if not y or y == n:  # nothing to learn from
        return Detector(BoostedTrees(), dict.fromkeys(KINDS, 2.0))
    trees = BoostedTrees()
    at = [i / trees.bins for i in range(trees.bins)]
    cuts = [np.unique(q) for q in learnt.agg(*[F.percentile(F.col("x")[j], at, F.col("n")).alias(f"q{j}") for j in range(width)]).first()]
    trees.cuts = cuts

    def bin_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = trees.binned(_matrix(b.column("x")))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.int32())), b.column("n"), b.column("y")], ["x", "n", "y"])

    binned = learnt.select("x", "n", "y").mapInArrow(bin_, "x array<int>, n long, y long").groupBy("x").agg(*counts).checkpoint()
    parts = -(-binned.count() // TABLE_ROWS)
    trees.fit(binned.repartition(parts).checkpoint(), cuts)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"))
            step = np.floor(trees.predict(x) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.argmax(x[:, :len(KINDS)], axis=1)), pa.array(step), b.column("n"), b.column("y")],
                                             ["kind", "step", "n", "y"])

    # at most STEPS rows a kind
    steps = (found.where("held").select("x", "n", "y").mapInArrow(grade, "kind long, step long, n long, y long")
             .groupBy("kind", "step").agg(*counts).orderBy(F.desc("step")).collect())
    threshold = {}
    for i, kind in enumerate(KINDS):
        own = [r for r in steps if r["kind"] == i]
        right = np.cumsum([r["y"] for r in own]) / np.cumsum([r["n"] for r in own])
        good = np.flatnonzero(right >= PRECISION)
        if not len(good):
            threshold[kind] = 2.0
            continue
        last = own[good[-1]]["step"]  # what is between it and the next lower one isn't told apart
        threshold[kind] = last / STEPS if any(STEPS <= 2 * r["step"] < 2 * last for r in own) else 0.5
    return Detector(trees, threshold)


def _listed(spans: dict[str, list[tuple[int, int]]]) -> list[str]:
    return [f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k])]


def find_personal_data(docs: DataFrame, detector: Detector, doc_id: str = "doc_id", text: str = "text",
                       mask: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``strict`` and ``spans``, lists of ``kind:start:end``
    in code points (strict formats; all selected spans), by kind, then start, and
    ``redacted``: the text with every selected span replaced by ``mask`` (null without a
    mask).  A null text has no spans and stays null.  Whole texts are read where they lie."""
    src = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("body"))
    interesting = re.compile("[0-9@]| at |\\[at\\]|\\(at\\)")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strict, spans, redacted = [], [], []
            for t in b.column("body").to_pylist():
                if t is None or not interesting.search(t):
                    base = every = {k: [] for k in KINDS}
                else:
                    base, more = detector.spans(t)
                    every = {k: base[k] + more[k] for k in KINDS}
                strict.append(_listed(base))
                spans.append(_listed(every))
                redacted.append(_masked(t, every, mask) if mask is not None and t is not None else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(strict, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.string())),
                 pa.array(redacted, pa.string())], ["doc", "strict", "spans", "redacted"])

    kind = src.schema["doc"].dataType.simpleString()
    return (src.mapInArrow(find, f"doc {kind}, strict array<string>, spans array<string>, redacted string")
            .withColumnRenamed("doc", doc_id))


def _masked(text: str, spans: dict, mask: str) -> str:
    out, at = [], 0
    for lo, hi in sorted(s for v in spans.values() for s in v):
        if hi <= at:
            continue
        if lo >= at:
            out += [text[at:lo], mask]
        at = hi
    return "".join(out) + text[at:]
