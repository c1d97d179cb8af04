"""Operators 11 to 13 against brute force, SQL and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelgap.llm import divergence, licenses, merkle, queries
from panelgap.testing import compare, duckdb_conn

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, unit long, place long, found string"
LONG = "tick tock " * 200_000
ROWS = [
    (1, "alpha Beta", "en", "a", 3, "x", 1, 1, None), (1, "alpha Beta", "en", "a", 3, "x", 1, 1, None),
    (2, None, None, None, None, None, None, None, None), (None, "null id\nkept", "en", "a", 1, None, None, None, None),
    (3, "", "", "", 0, "", 0, 0, ""), (4, "lone", "de", "b", 4, "y", 0, 0, ""), (5, LONG, "en", "c", 5, "y", 1, 1, ""),
    (6, "ß" * 3_000_000, "en", "c", 5, "y", 1, 1, ""), (7, "9 - !", "en", "d", 5, "y", 1, 1, ""),
    (8, "Äpfel äpfel MIT\nLicense mit license", "en", "a", 1, "z", 1, 1, ""),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- 11 divergence

def plain_audit(rows, min_docs=10, top=10):
    """Every kept term of every pair, in whole numbers of any size."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    cell, seen = {}, {}
    for lang, source, text in rows:
        ts = term.findall((text or "").translate(LOWER))
        cell.setdefault((lang or "", source or ""), Counter()).update(ts)
        seen.setdefault(lang or "", Counter()).update(set(ts))
    out = []

    def shares(count, v):
        n = sum(count.values())
        return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(v)) for t in v}

    for lang, df in seen.items():
        v = [t for t, n in df.items() if n >= min_docs]
        own = {s: Counter({t: c[t] for t in v if c[t]}) for (x, s), c in cell.items() if x == lang}
        whole = shares(sum(own.values(), Counter()), v) if v else {}
        p = {s: shares(c, v) if v else {} for s, c in own.items()}
        for s in own:
            parts = {"pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in v)) for o in own if o != s],
                     "term": [(t, (p[s][t] - whole[t]) ** 2 // (p[s][t] + whole[t])) for t in v if own[s][t] and p[s][t] > whole[t]]}
            for part, items in parts.items():
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:top if part == "term" else None]
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(items)]
    return sorted(out)


def audit_rows(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("block_terms", [5, 1 << 16])
def test_audit_matches_brute_force_with_any_block_size(spark, block_terms):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert audit_rows(divergence.divergence_audit(docs, min_docs=3, block_terms=block_terms)) == plain_audit(rows, 3)


def test_audit_odd_rows_and_sql(spark, odd, none):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    rows = [(r[2], r[3], r[1]) for r in ROWS]
    assert audit_rows(divergence.divergence_audit(docs, min_docs=2)) == plain_audit(rows, 2)
    for path in (odd, none, SF):
        ok, why = compare(queries.op11_divergence(spark, path), duckdb_conn(path), queries.oracle_sql()["op11_divergence"])
        assert ok, why


def test_merge_and_gallop_on_lopsided_arrays():
    rng = np.random.default_rng(7)
    for size, other in ((0, 0), (0, 50), (3, 40_000), (700, 701), (5_000, 200)):
        a, b = (np.sort(rng.choice(60_000, n, replace=False)) for n in (size, other))
        assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
        ca, cb = rng.integers(1, 10**9, len(a)), rng.integers(1, 10**9, len(b))
        na, nb, v = int(ca.sum()) + 5, int(cb.sum()) + 7, 60_000
        da, db = dict(zip(a.tolist(), ca.tolist(), strict=True)), dict(zip(b.tolist(), cb.tolist(), strict=True))
        want = 0
        for t in da.keys() | db.keys():
            p, q = (1 + 10**9 * (c.get(t, 0) + 2) // (n + 2 * v) for c, n in ((da, na), (db, nb)))
            want += (p - q) ** 2 // (p + q)
        assert divergence.merge(a, ca, na, b, cb, nb, v) == (want, len(da.keys() | db.keys()))


def test_shares_are_exact_for_large_counts(spark):
    rows = [(0, 0, 1), (10**14, 10**15, 10**6), (8 * 10**15, 8 * 10**15, 10**8), (1, 3, 0)]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.scaled_share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) if v else None for c, n, v in rows]
    assert divergence._shares(np.array([10**14]), 10**15, 10**6).tolist() == got[1:2]


# ---- 12 licences

def plain_base(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(ws))
                  if ws[i:i + len(phrase.split())] == phrase.split())
    return (len(ws), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({x for _, x in hits})))


def base_rows(df):
    return Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect())


def test_licence_phrases_match_brute_force(spark, odd, none):
    for path in (SF, odd):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
        got = queries.op12_licenses(spark, path)
        assert base_rows(got) == Counter((d, *plain_base(t)) for d, t in rows)
        for r in got.collect():
            assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert queries.op12_licenses(spark, none).count() == 0


def test_licence_phrases_random(spark):
    rng, vocab = random.Random(3), ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "x"]
    rows = [(i, rng.choice([" ", "\n", "-"]).join(rng.choices(vocab, k=rng.randrange(0, 400)))) for i in range(60)]
    index = licenses.PositionalIndex(licenses.phrases())
    for idf in (np.ones(len(index.ids)), np.array([rng.random() + 0.1 for _ in index.ids])):
        scanner = licenses.Scanner(index, idf)
        for _, text in rows:
            n, found = scanner.find(text)
            starts = sorted((lo, index.templates[t].label) for t, lo, _, _ in found)
            want = plain_base(text)
            assert (n, len(starts)) == want[:2] and (not starts or (starts[0][0], starts[-1][0]) == want[2:4])


def plant(notice, rng, kind):
    words = notice.split()
    if kind == "inserted":  # a name and a year in the middle
        words[len(words) // 2:len(words) // 2] = ["Example", "2024"]
    return " ".join(words)


def test_notices_are_found_with_insertions_and_not_in_parts(spark):
    rng = random.Random(11)
    filler = [w for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect() for w in (r.text or "").split()[:200]]
    rows, want = [], {}
    for i, (label, notice, keys) in enumerate(licenses.NOTICES):
        for j, kind in enumerate(("plain", "inserted", "cut")):
            around = [" ".join(rng.choices(filler, k=rng.randrange(30, 300))) for _ in range(2)]
            text = " ".join(notice.split()[:2]) if kind == "cut" else plant(notice, rng, kind)
            if kind == "inserted" and any(k not in " ".join(w.decode() for w in licenses.split_words(text)) for k in keys):
                continue  # the insertion tore a mandatory phrase
            rows.append((10 * i + j, f"{around[0]}\n{text}\n{around[1]}"))
            want[10 * i + j] = None if kind == "cut" else label
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = licenses.PositionalIndex(licenses.notices())
    scanner = licenses.Scanner(index, licenses.inverse_frequencies(docs, index))
    for r in licenses.scan_licenses(docs, scanner).collect():
        labels = {x["label"] for x in r.found}
        assert want[r.doc_id] is None and not labels or want[r.doc_id] in labels, (r.doc_id, want[r.doc_id], labels)


def test_several_notices_and_places_in_one_file(spark):
    text = " ".join(n for _, n, _ in licenses.NOTICES) + " word" * 500 + " " + licenses.NOTICES[5][1]
    index = licenses.PositionalIndex(licenses.notices())
    n, found = licenses.Scanner(index, np.ones(len(index.ids))).find(text)
    assert {index.templates[t].label for t, *_ in found} == {x[0] for x in licenses.NOTICES}
    assert [lo for t, lo, _, _ in found if index.templates[t].label == "mit"][-1] == n - len(licenses.split_words(licenses.NOTICES[5][1]))


# ---- 13 Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def plain_tree(leaves):
    """Root, and for each leaf its siblings by level as (left, right)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, p in enumerate(at):
            run = runs[p // 3]
            paths[k].append(("".join(run[:p % 3]), "".join(run[p % 3 + 1:])))
        level, at = [h(*r) for r in runs], [p // 3 for p in at]
    return level[0], paths


def plain_manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars, ...) as the contract wants them."""
    rows = sorted(rows, key=lambda r: (r[3] is not None, (r[3] or "").encode(), r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r[3])]
    trees = [plain_tree([plain_leaf(r, r[1]) for r in g]) for g in groups]
    root, above = plain_tree([t[0] for t in trees])
    out = Counter()
    for g, (subroot, paths), up in zip(groups, trees, above, strict=True):
        for r, path in zip(g, paths, strict=True):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            fold = plain_leaf(r, r[1].replace("\n", "") if even and r[1] is not None else r[1])
            for left, right in path + up:
                fold = h(left, fold, right)
            out[r[0], plain_leaf(r, r[1]), subroot, root, h(*(x for s in path + up for x in s)), fold, fold == root] += 1
    return out


COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_matches_brute_force_and_sql(spark, odd, none):
    for path in (odd, SF):
        rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
        got = queries.op13_merkle(spark, path)
        assert Counter(tuple(r[c] for c in COLS) for r in got.collect()) == plain_manifest(rows)
        ok, why = compare(got, duckdb_conn(path), queries.oracle_sql()["op13_merkle"])
        assert ok, why
    assert queries.op13_merkle(spark, none).count() == 0


@pytest.mark.parametrize(("levels", "sizes"), [(1, [1, 2, 3, 4, 9, 10, 28, 100]), (2, [250, 1, 1, 1, 81, 82] + [1] * 90), (1, [730]),
                                               (6, [1]), (1, [1] * 120)])
def test_manifest_of_trees_of_many_sizes(spark, levels, sizes):
    """Small units, so that large sources, series of small ones and several rounds all occur."""
    rng = random.Random(sum(sizes))
    rows = [(rng.randrange(10**6), f"t\n{rng.random()}", "en", None if s == 0 else f"s{s:03d}", i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    got = merkle.merkle_proofs(docs, "source", "doc_id", merkle.leaf_hash(*first, F.col("text")), levels=levels).collect()
    want = plain_manifest(rows)
    assert len(got) == len(rows)
    seen = {(k[0], k[1]): k for k in want}
    for r in got:
        k = seen[r.doc_id, r.leaf]
        fold = r.leaf
        for x in r.proof:
            fold = h(x.left, fold, x.right)
        assert (r.subroot, r.root, h(*(y for x in r.proof for y in x)), fold) == (*k[2:5], r.root)


def test_missing_nodes_are_minimal():
    """What an interval lacks: exactly the siblings that its own leaves can't give."""
    for size in (1, 2, 7, 27, 50):
        widths = [merkle.width(size, k) for k in range(merkle.height(size) + 1)]
        for lo in range(0, size, 3):
            for hi in range(lo, size, 5):
                known, wanted = set(), set()
                span = set(range(lo, hi + 1))
                for level, n in enumerate(widths[:-1]):
                    wanted |= {(level, q) for p in span for q in range(p // 3 * 3, min(p // 3 * 3 + 3, n)) if q not in span}
                    known |= {(level, p) for p in span}
                    span = {p // 3 for p in span}
                assert set(merkle.missing(lo, hi, size)) == wanted and not wanted & known


def test_one_row_repeated_and_one_source(spark):
    rows = [(7, "same\ntext", "en", "s", 1)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.merkle_proofs(docs, "source", "doc_id", merkle.leaf_hash(F.col("doc_id"), F.col("text")), levels=2)
    assert {r[0] for r in got.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root"))).collect()} == {True}
    assert got.count() == 40 and got.select("subroot").distinct().count() == 1
