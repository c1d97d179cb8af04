"""Each operator against brute force on the small tables, and on awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelgap.llm import chunks as C
from panelgap.llm import language_id, language_model, mixing, pii, quality, queries, sharding, simhash, urls
from panelgap.llm.components import connected_components
from panelgap.llm.decontaminate import MASKS, SIMILARITY, decontaminate, overlaps
from panelgap.llm.substring_dedup import remove_repeats
from panelgap.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
PROSE = " ".join(f"word{i}" for i in range(60))
ROWS = [  # doc_id, text, lang, source, and columns whose names clash with inner ones
    (1, PROSE, "en", "a", 1, "x", 0, 0), (2, PROSE, "en", "a", 1, "x", 0, 0), (2, PROSE, "en", "a", 1, "x", 0, 0),
    (3, None, None, None, None, None, None, None), (4, "", "", "", 0, "", 0, 0), (None, PROSE, None, "b", 1, None, 0, 0),
    (5, " \t\n ", "de", "b", 4, "y", 1, 1), (6, "a" * 50_000, "en", "c", 5, "y", 1, 1),
    (7, "tick tock " * 30_000, "en", "c", 5, "y", 1, 1), (8, "ÄÖ ü\u2003x 🙂 \x0b z", "de", "b", 4, "y", 1, 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, copies int, shard int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def words(text):
    return [] if text is None else text.encode().split()


# ---- words and components

def test_word_hashes_tell_words_apart():
    ts = ["a b  a\tc\x0b", None, "", "ab a " * 400_000, "é É"]
    h, d = word_hashes(ts)
    flat = [(i, w) for i, t in enumerate(ts) for w in words(t)]
    assert d.tolist() == [i for i, _ in flat]
    seen = {}
    assert all(seen.setdefault(w, x) == x for (_, w), x in zip(flat, h.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# ---- 1 quality rules

def base_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    c, cover = Counter(grams), [False] * len(w)
    for i, g in enumerate(grams):
        if c[g] > 1:
            cover[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), sum(cover))


def test_quality_counts_match_brute_force(spark, odd, texts):
    rows = queries.op1_quality(spark, SF).collect()
    expected = {d: base_counts(t) for d, t in texts}
    assert {r.doc_id: tuple(r[1:6]) for r in rows} == expected
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert sorted(tuple(r[1:6]) for r in quality.quality_report(odd).collect()) == sorted(base_counts(r[1]) for r in ROWS)


def test_quality_verdict_does_not_depend_on_the_order(spark, docs):
    t = F.col("text")
    m = quality.Measures(t, quality.words(t))
    one = docs.where(quality.cascade(m, list(quality.RULES)).isNull()).select("doc_id").collect()
    two = docs.where(quality.cascade(m, list(quality.RULES)[::-1]).isNull()).select("doc_id").collect()
    assert set(one) == set(two) == set(quality.quality_filter(docs).select("doc_id").collect())


def test_quality_keeps_good_and_rejects_most_bad(spark, docs):
    kept = quality.quality_report(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("not base_failed")
    good, bad = kept.where("quality = 1"), kept.where("quality = 0")
    assert good.where("not kept").count() == 0 and bad.where("kept").count() <= 0.2 * max(1, bad.count())


def test_quality_of_odd_and_no_rows(odd, none):
    assert sorted(r.doc_id or 0 for r in quality.quality_filter(odd).collect()) == [0, 1, 2, 2]
    assert quality.quality_filter(odd).columns == odd.columns
    assert quality.quality_filter(none).count() == quality.quality_report(none).count() == 0


# ---- 2 sharding

def test_shards_differ_by_one_and_slots_have_no_gaps(spark, odd, none):
    rows = queries.op2_sharding(spark, SF).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    out = sharding.shard(odd, 3)
    assert sorted(Counter(r.shard for r in out.collect()).values()) == [3, 3, 4]
    assert set(out.columns) == {*odd.columns, "slot"} and sharding.shard(none, 3).count() == 0


def test_ring_moves_few_keys_and_holds_its_bound():
    counts = {c: 3 for c in range(0, sharding.CELLS, 37)}
    total = sum(counts.values())

    def owner(shards, slack):
        cover = sharding.place_cells(counts, shards, slack)
        return {(c, r): s for c, lo, hi, s, _ in cover for r in range(lo, hi)}

    for slack in (0.0, 0.1):
        a, b = owner(8, slack), owner(9, slack)
        assert len(a) == total and max(Counter(a.values()).values()) <= max(sharding.load_bounds(total, 8, slack))
        assert sum(a[k] != b[k] for k in a) < 0.35 * total


# ---- 3 personal data

def plain_spans(t):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            s += x - 9 * (x > 9)
        return s % 10 == 0

    return {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
                   if all(int(x) <= 255 for x in m.group().split("."))],
            "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
            "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]}


def test_strict_spans_match_the_plain_patterns(texts):
    rng = random.Random(3)
    made = ["".join(rng.choice("01259 .-@+()ab") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    made += [" ".join(rng.choice(["4111111111111111", "10.0.0.1", "a@b.c", "+1 (266) 555-7228", "256.1.1.1", "-", "@"])
                      for _ in range(6)) for _ in range(500)]
    assert all(pii.strict_spans(t) == plain_spans(t) for t in [*made, *(t for _, t in texts if t)])


def test_detector_adds_loose_forms_and_leaves_numbers_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    det = pii.fit(docs)
    assert det.spans("write to anna.k at mail dot example dot com today")[1]["email"]
    assert det.spans("phone: (266) 555-7228 now")[1]["phone"]
    for clean in ("order 1219538112535716 shipped", 'token = "2321bac4d15ec8f90433955bf9d3cf6"', "in 1999 and 2004, 12 of 300"):
        assert not any(det.spans(clean)[1].values())


def test_detector_learns_where_the_corpus_holds_loose_forms(spark):
    rng = random.Random(5)

    def phone():
        return f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"

    def name():
        return "".join(rng.choices("abcdefgh", k=6))

    def card(sep):
        d = "4" + "".join(rng.choices("0123456789", k=14))
        d = next(d + c for c in "0123456789" if pii._luhn_sum(d + c) % 10 == 0)
        return sep.join(d[i:i + 4] for i in range(0, 16, 4))

    made = []
    for i in range(1200):
        strict = (f"call +1 {phone()} or mail {name()}@{name()}.com pay {card(' ')} ok", "nothing here")[i % 2]
        loose = f"call {phone()} or mail {name()} at {name()} dot com pay {card('  ')} ok"
        clean = f"order {rng.randint(10**9, 10**10 - 1)} of 2021-{rng.randint(10, 12)}-{rng.randint(10, 28)} shipped"
        made.append((i, f"{strict}; {loose}; {clean}"))
    det = pii.fit(spark.createDataFrame(made, "doc_id long, text string").repartition(3, "doc_id"))
    for text, kind in (("call (212) 555-0147 now", "phone"), ("mail abcdef at hgfedc dot com now", "email"),
                       ("pay 4111  1111  1111  1111 now", "card")):
        assert det.spans(text)[1][kind], kind
    for clean in ("order 1219538112535 shipped", "order 2125550147 shipped", "on 2021-11-12 we met", "pay 4111  1111  1111  1112 now"):
        assert not any(det.spans(clean)[1].values()), clean


def test_only_broken_formats_are_negative():
    def broken(text):
        return [(k, pii.breaks_rule(text, k, a, b)) for k, a, b in pii.loose_candidates(text)]

    for text in ("(212) 555-0147", "212-555-0147", "ann at host dot com", "4111  1111  1111  1111", "10 . 0 . 0 . 1"):
        assert broken(text) and not any(x for k, x in broken(text) if not (k == "phone" and "." in text))
    for text in ("2125550147", "2021-11-12", "4111  1111  1111  1112", "256 . 1 . 1 . 1", "1,2,3,4",
                 "meet at 10 dot 30", "1.234.567", "a2125550147"):
        assert broken(text) and all(x for _, x in broken(text)), text


def test_pii_query_and_odd_rows(spark, odd, none, texts):
    rows = {r.doc_id: r for r in queries.op3_pii(spark, SF).collect()}
    for d, t in texts:
        own = [f"{k}:{a}:{b}" for k, v in plain_spans(t or "").items() for a, b in v]
        assert rows[d].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert set(own) <= set(rows[d].spans.split(",")) | {""}
    det = pii.fit(none)
    got = pii.find_personal_data(odd, det, mask="*").collect()
    assert len(got) == len(ROWS) and all(r.spans == [] for r in got)
    assert pii.find_personal_data(none, det).count() == 0
    masked = spark.createDataFrame([(1, "to a@b.cd, 10.0.0.1.")], "doc_id long, text string")
    assert pii.find_personal_data(masked, det, mask="#").first().redacted == "to #, #."


# ---- 4 decontamination

def test_masks_meet_every_overlap_with_a_fifth_changed():
    for window in range(8, 17):
        wrong = window - math.ceil(SIMILARITY * window)
        at = [tuple(o + x for x in m) for m in MASKS for o in range(window - m[-1])]
        for bad in itertools.combinations(range(window), wrong):
            assert any(not set(p) & set(bad) for p in at)


def brute_overlaps(texts, items):
    out = set()
    for d, t in texts:
        w = words(t and t.lower())
        for i, s in items:
            v = words(s.lower())
            n = min(16, len(v))
            if len(v) < 8:
                continue
            need = math.ceil(SIMILARITY * n)
            for a in range(len(w) - n + 1):
                if any(sum(x == y for x, y in zip(w[a:a + n], v[b:b + n], strict=True)) >= need for b in range(len(v) - n + 1)):
                    out.add((d, i))
                    break
    return out


def test_overlaps_match_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(5, 30)))) for i in range(25)]
    texts = []
    for d in range(120):
        w = rng.choices(vocab, k=rng.randint(0, 60))
        if d % 2:
            part = items[rng.randrange(25)][1].split()
            part = part[rng.randint(0, 4):len(part) - rng.randint(0, 4)]
            part = [rng.choice(vocab) if rng.random() < 0.18 else x.upper() for x in part]
            at = rng.randint(0, len(w))
            w[at:at] = part
        texts.append((d, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_overlaps(texts, items)
    assert len(expected) > 20
    for block in (10, 10_000):  # many blocks and one
        got = [(r.doc_id, r.item_id) for r in overlaps(df, bench, block_words=block).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_benchmark_items_in_documents_are_found(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op4_decontaminate(spark, SF).collect()}
    assert {(d, i) for d, t in texts for i, s in items if t and s.lower() in t.lower()} <= got


def test_decontaminate_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, " ".join(PROSE.split()[3:30])), (2, None), (3, ""), (4, "tick tock")], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in decontaminate(odd, bench).collect()) == ["3", "4", "5", "6", "7", "8"]
    assert decontaminate(odd, bench).columns == odd.columns
    assert decontaminate(none, bench).count() == 0 and decontaminate(odd, bench.where("false")).count() == len(ROWS)


# ---- 5 mixing

def test_targets_share_all_words_under_the_cap():
    t = mixing.source_targets([("a", 100), ("b", 1000), ("c", 10), (None, 890)])
    assert t[0] == 300 and t[2] == 30 and math.isclose(sum(t), 2000) and all(x <= 3 * n for x, n in zip(t, (100, 1000, 10, 890), strict=True))
    assert mixing.source_targets([]) == [] and mixing.source_targets([("a", 0)]) == [0.0]


def test_mix_reaches_its_targets_and_tilts_exponentially(spark, texts):
    rows = queries.op5_mixing(spark, SF).collect()
    assert {r.doc_id: r.size for r in rows} == {d: len(words(t)) for d, t in texts}
    assert sorted(rows) == sorted(queries.op5_mixing(spark, SF).collect())
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r)
        assert r.taken <= 3 * r.size
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own if r.size)


def test_dual_solution_is_the_tilt_that_meets_the_target(spark):
    sizes = [5, 20, 20, 60, 200]
    import pandas as pd
    whole = sum(sizes)
    groups = spark.createDataFrame([(s, z, n, z / 61) for s in (0, 1, 2) for z, n in Counter(sizes).items()],
                                   "s int, size long, n long, x double")
    target = [0.4 * whole, 2.2 * whole, 3.0 * whole]
    dual = mixing._solve(groups, pd.DataFrame({"words": [whole] * 3, "target": target}), 3.0)
    assert np.isinf(dual[2])
    for lam, t in zip(dual[:2], target, strict=False):
        assert math.isclose(sum(z * min(3.0, math.exp(lam * z / 61)) for z in sizes), t, rel_tol=1e-6)


def test_mixed_odd_rows(odd, none):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and {r.doc_id for r in out.collect()} <= {r[0] for r in ROWS}
    assert len(mixing.mix(odd).collect()) == len(ROWS)
    assert mixing.mixed(none).count() == 0


# ---- 6 language identification

def test_languages_of_held_out_documents(spark, docs, odd, none):
    rows = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(odd, F.lit(False)).collect()}
    assert {d for d, p in got.items() if p == "und"} == {3, 4, 5}
    assert {r.lang_pred for r in language_id.identify(odd, F.lit(True)).collect()} == {"und"}
    assert language_id.identify(none, F.lit(False)).count() == 0


def test_text_vector_is_the_sum_of_bound_trigrams():
    v, has = language_id.text_vectors(["Ab!c", "12", None])
    expected = sum(np.roll(language_id._letter_vector(ord(a)), 2) * np.roll(language_id._letter_vector(ord(b)), 1)
                   * language_id._letter_vector(ord(c)).astype(int) for a, b, c in (" ab", "ab ", " c "))
    assert (v[0] == expected).all() and has.tolist() == [True, False, False]


# ---- 7 SimHash

def plain_fingerprint(t):
    w = words(t.lower() if t and t.isascii() else "".join(c.lower() if c.isascii() else c for c in t or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fp = np.array([f for _, f in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= 3):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(rows))]


def test_simhash_matches_brute_force(spark, odd, none, texts):
    rows = [(d, plain_fingerprint(t)) for d, t in texts]
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op7_simhash(spark, SF).collect()}
    assert got == {d: (f, c) for (d, f), c in zip(rows, plain_components(rows), strict=True)}
    odd_rows = [(r[0], plain_fingerprint(r[1])) for r in ROWS]
    expected = Counter((d, f"{f:016x}", c) for (d, f), c in zip(odd_rows, plain_components(odd_rows), strict=True))
    assert Counter(tuple(r) for r in simhash.simhash_components(odd).collect()) == expected
    assert simhash.simhash_components(none).count() == 0


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for f in list(fps):
        for _ in range(4):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    expected = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2)
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == expected


def test_one_row_of_each_component_stays(odd, none):
    kept = simhash.drop_near_duplicates(odd).collect()
    components = {r.component_id for r in simhash.simhash_components(odd).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(components) and simhash.drop_near_duplicates(odd).columns == odd.columns
    assert simhash.drop_near_duplicates(none).count() == 0


# ---- 8 urls

def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_url_rules_match_brute_force(spark):
    odd = [None, "", "a.com/x", "HTTP://WWW.Example.COM/en/1?x=/a#b", "http://com", "http://x.net/es/", "http://Net/es/1#q",
           "http://notnet/es/", "://?", "ftp://a.b/c://d", "http://example.com/en/", "http://h.org/" + "9/" * 5000]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(odd)], "page_id long, url string"))
    given = {r.page_id: r.url for r in pages.collect()}
    rows = urls.filter_urls(pages, queries.URL_RULES).collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path, rule, verdict = plain_rule(given[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
        assert r.verdict in ("allow", "block")
    assert urls.filter_urls(pages.where("false"), queries.URL_RULES).count() == 0


def test_templates_learn_from_labelled_urls(spark):
    rows = [(i, f"http://h.org/{'spam' if i % 2 else 'news'}/{i}/x{i}.html") for i in range(200)]
    rules = [urls.UrlRule("h.org", f"/spam/{i}/", "block") for i in range(1, 60, 2)] \
        + [urls.UrlRule("h.org", f"/news/{i}/", "allow") for i in range(0, 60, 2)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()
    assert len(out) > 100 and all((r.verdict == "block") == ("/spam/" in r.path) for r in out)


def test_segments_are_told_apart_at_any_depth(spark):
    deep = "/2024/05/12/section/x/y/"
    rows = [(i, f"http://h.org{deep}{'spam' if i % 2 else 'news'}/{i}/x{i}.html") for i in range(200)]
    rules = [urls.UrlRule("h.org", f"{deep}spam/{i}/", "block") for i in range(1, 60, 2)] \
        + [urls.UrlRule("h.org", f"{deep}news/{i}/", "allow") for i in range(0, 60, 2)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule is null").collect()
    assert len(out) > 100 and all((r.verdict == "block") == ("/spam/" in r.path) for r in out)
    assert {r.template for r in out} == {f"<n>/<n>/<n>/section/x/y/{k}/<n>/x<n>.html" for k in ("spam", "news")}
    # names beneath a long common way become a wildcard there, in a few rounds
    names = ["".join(random.Random(i).choices("ghijklmnop", k=9)) for i in range(60)]
    rows = [(i, "http://h.org/" + "a/" * 3000 + n) for i, n in enumerate(names)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), [])
    assert {r.template for r in out.select("template").collect()} == {"a/" * 3000 + "*"}


def test_a_node_with_many_rare_children_becomes_a_wildcard(spark):
    names = ["".join(random.Random(i).choices("ghijklmnop", k=9)) for i in range(300)]
    rows = [(i, f"http://h.org/user/{n}") for i, n in enumerate(names)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), [])
    assert {r.template for r in out.select("template").distinct().collect()} == {"user/*"}


# ---- 9 language model

def test_unigram_scores_match_brute_force(spark, odd, none, texts):
    rows = {r.doc_id: r for r in queries.op9_language_model(spark, SF).collect()}
    tokens = {d: [*("".join(c.lower() if c.isascii() else c for c in t or "").encode().split()), None] for d, t in texts}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for d in train for w in tokens[d])
    n, v = sum(c.values()), len(c)
    for d, w in tokens.items():
        r = rows[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(c[x] > 0 for x in w), n, d not in train)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    got = language_model.score_texts(odd, F.col("doc_id") < 3).collect()
    assert len(got) == len(ROWS) and all(r.train_tokens == 3 * 61 and r.score < 0 for r in got)
    assert language_model.score_texts(odd, F.lit(False)).where("n_known > 0").count() == 0
    assert language_model.score_texts(none, F.lit(True)).count() == 0


def test_filter_gives_levels_with_few_errors():
    keys = np.random.default_rng(1).integers(1, 1 << 62, 3000).astype(np.uint64)
    true = np.arange(3000) % 6
    size = 12 * int(true.sum()) // 8 * 8
    bits = np.zeros(size, np.uint8)
    for level in range(1, 6):
        for i in range(language_model.PROBES):
            bits[language_model.LogBloom.place(keys[true >= level], level, i, size)] = 1
    got = language_model.LogBloom(np.packbits(bits, bitorder="little")).levels(keys)
    assert (got >= true).all() and (got == true).mean() > 0.98
    counts = np.array([1, 2, 3, 4, 7, 8, 100])
    assert language_model.level_of(counts, 1.0).tolist() == [0, 1, 1, 2, 2, 3, 6]
    assert language_model.level_of(counts, 3.0).tolist() == [0, 0, 0, 0, 1, 1, 5]


def test_each_training_ngram_is_held_whatever_the_corpus():
    rng = np.random.default_rng(2)
    starts, keys = np.array([0, 1 << 63], np.uint64), np.sort(rng.integers(0, 1 << 60, 4000).astype(np.uint64))
    count = np.array([0, 1, 2, 3], np.uint64).repeat(1000)
    count[-1] = 1 << 40  # one word is nearly the whole corpus: 32,768 times 2 ** 25 tokens
    seen = count > 0
    rows = C.table([(kind, 0, 7, C.pack(keys[seen]), C.pack_counts(count[seen])) for kind in (1, 2)], language_model._COUNTS)
    for kind in (1, 2):
        out = language_model._block(rows.slice(kind - 1, 1), starts)
        stats = {r["level"]: (r["types"], r["total"]) for r in out.to_pylist() if r["level"] is not None}
        assert stats == {1: (1000, 1000), 2: (1999, 1000 * 2 + 999 * 3), 41: (1, 1 << 40)}
        block = out.slice(0, 1).rename_columns([f"b_{c}" for c in out.column_names])
        asked = C.table([(kind, 0, 7, C.pack(keys))], language_model._ASKED)
        answer, = language_model._answer(asked, block, starts).to_pylist()
        assert answer["chunk"] == 7
        read, true = C.unpack_counts(answer["levels"]), np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0)
        assert (read >= true).all() and (read[:1000] == 0).mean() > 0.98 and (read == true).mean() > 0.98
        if kind == 1:
            assert (C.unpack_counts(answer["counts"]) == count).all()
    mean = language_model._level_means([{"kind": k, "level": 1, "types": 9, "total": 9} for k in (1, 2)])
    assert all(mean[k][0] == 0 and mean[k][1] == 1 for k in (1, 2))


# ---- 10 substring deduplication

def brute_repeats(rows, window=13):
    low, out = {}, []
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            low[g] = min(low.get(g, math.inf), math.inf if d is None else d)
    for d, t in rows:
        w = words(t)
        cut = [False] * len(w)
        for i in range(len(w) - window + 1):
            if low[tuple(w[i:i + window])] < (math.inf if d is None else d):
                cut[i:i + window] = [True] * window
        kept = b" ".join(x for x, y in zip(w, cut, strict=True) if not y)
        out.append((d, len(w), sum(cut), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_match_brute_force(spark, odd, none, texts):
    assert Counter(tuple(r) for r in queries.op10_substring_dedup(spark, SF).collect()) == Counter(brute_repeats(texts))
    assert Counter(tuple(r) for r in remove_repeats(odd, emit="sha256").collect()) == Counter(brute_repeats([r[:2] for r in ROWS]))
    assert remove_repeats(none).count() == 0


def test_buckets_follow_the_bytes_of_the_texts(spark, docs, odd, none, texts, monkeypatch):
    def results():
        return (sorted(queries.op10_substring_dedup(spark, SF).collect()),
                [(r.doc_id, r.n_known, round(r.base_score, 6)) for r in queries.op9_language_model(spark, SF).orderBy("doc_id").collect()])

    least = C.BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = sum(len((t or "").encode()) for _, t in texts)
    assert C.bucket_count(docs, "text") == C.bucket_count(none, "text") == least
    few = results()
    monkeypatch.setattr(C, "BUCKET_TEXT", size // (least + 50))
    assert C.bucket_count(docs, "text") == -(-size // C.BUCKET_TEXT) >= least + 50
    assert results() == few


@pytest.mark.parametrize("window", [5, 8, 13])
def test_random_repeats_match_brute_force(spark, window):
    rng = random.Random(window)
    parts = [[rng.choice("abcdef") for _ in range(rng.randint(3, 25))] for _ in range(12)]
    rows = [(rng.randrange(50), " ".join(x for _ in range(rng.randint(0, 6)) for x in rng.choice(parts))) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in remove_repeats(df, window=window, emit="sha256").collect())
    assert got == Counter(brute_repeats(rows, window))
