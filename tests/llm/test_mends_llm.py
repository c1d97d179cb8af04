"""Failing-first tests of mended operators: odd columns, tiny and repeated tables, hot ids."""

import math
import os
import random
import re
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelgap.llm import language_id, language_model, pii, quality, queries, sharding, simhash, urls
from panelgap.llm.oracle import urls_sql
from panelgap.testing import compare

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TEXT = "Call 212-555-0147 or +1 212 555 0147 99, card 4111 1111 1111 1111, mail jo@example.com or 10.1.2.3"
INNER = ["at", "at_", "tie", "tie_", "cell", "cell_", "rank", "rank_", "lo", "lo_", "hi", "hi_", "first", "slot0_", "row",
         "SHARD", "Slot", "rid", "chunk", "body", "k0", "_mixing_row", "_simhash_row", "times"]


@pytest.mark.parametrize("texts", [[], [TEXT], [TEXT] * 5, [None, "", None], ["no data"] * 3, [TEXT, TEXT + " again"]])
def test_pii_fit_on_tiny_and_repeated_tables(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_personal_data(docs, pii.fit(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert set(r.strict) <= set(r.spans)


def test_loose_candidates_have_no_length_bound():
    name = "a" * 100
    (kind, lo, hi), = [c for c in pii.loose_candidates(f"x {name} at example dot com y") if c[0] == "email"]
    assert (lo, hi) == (2, 2 + len(name) + len(" at example dot com"))
    digits = "1-" * 30 + "1"
    assert [(lo, hi) for k, lo, hi in pii.loose_candidates(f" {digits} ") if k == "card"] == [(1, 1 + len(digits))]


def with_odd_columns(docs):
    for i, c in enumerate(INNER):
        docs = docs.withColumn(c, F.lit(i))
    return docs.withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("a`b", F.array(F.create_map(F.lit(1), F.lit(2))))


def test_shard_keeps_columns_of_any_name_and_type(spark):
    docs = with_odd_columns(spark.read.parquet(f"{SF}/documents.parquet"))
    out = sharding.shard(docs, 8)
    assert out.columns == [c for c in docs.columns if c.lower() not in ("shard", "slot")] + ["shard", "slot"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(r["tags"] == {"k": r["doc_id"]} and r["at_"] == 1 for r in rows)
    check_slots(rows, 8)


def check_slots(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))


def test_one_id_with_most_rows_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CROWDED_ROWS", 50)
    docs = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                       (F.col("id") % 10).alias("v"))
    out = sharding.shard(docs, 8)
    check_slots(out.collect(), 8)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window") >= 1
    assert Counter((r.doc_id, r.v) for r in out.collect()) == Counter((r.doc_id, r.v) for r in docs.collect())


def test_pipeline_with_odd_columns_and_empty(spark, tmp_path):
    docs = with_odd_columns(spark.read.parquet(f"{SF}/documents.parquet"))
    for name, frame in (("odd", docs), ("none", docs.limit(0))):
        sf = str(tmp_path / name)
        frame.write.parquet(f"{sf}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
    odd = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    plain = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in odd.select("doc_id").collect()} == {r.doc_id for r in plain.select("doc_id").collect()}
    assert set(c.lower() for c in docs.columns) - {"shard", "slot"} <= set(c.lower() for c in odd.columns)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


# ---- 9: the model is stored, apart from the scoring, and scores rest on probes alone

def plain_tokens(text):
    return [*re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode().split(), None]


def plain_model(train):
    """Counts of words and bigrams, and the mean count of each level."""
    words, pairs = Counter(), Counter()
    for t in train:
        ws = plain_tokens(t)
        words.update(ws)
        pairs.update(zip([None, *ws[:-1]], ws, strict=True))
    means = []
    for counts in (words, pairs):
        by = {}
        for c in counts.values():
            by.setdefault(c.bit_length(), []).append(c)
        means.append({v: sum(c) / len(c) for v, c in by.items()})
    return words, pairs, means


def plain_score(text, words, pairs, means):
    n, v = sum(words.values()), len(words)
    ws, out = plain_tokens(text), 0.0

    def mean(k, counts, x):
        return means[k][counts[x].bit_length()] if counts[x] else 0.0

    for before, w in zip([None, *ws[:-1]], ws, strict=True):
        p1 = (mean(0, words, w) + 0.5) / (n + 0.5 * (v + 1))
        p2 = min(1.0, mean(1, pairs, (before, w)) / max(mean(0, words, before), 0.5))
        out += math.log10(language_model.BIGRAM_WEIGHT * p2 + (1 - language_model.BIGRAM_WEIGHT) * p1)
    return out


def test_a_stored_model_scores_another_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train, other = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    other.write.parquet(str(tmp_path / "other"))
    other = spark.read.parquet(str(tmp_path / "other"))
    path = str(tmp_path / "model")
    model = language_model.fit(train, path=path)
    again = language_model.StoredModel.load(spark, path)
    assert (again.path, again.buckets, again.n, again.v) == (path, model.buckets, model.n, model.v)
    assert all((again.mean[k] == model.mean[k]).all() for k in (1, 2))
    plain = plain_model([r.text for r in train.collect()])
    got = {r.doc_id: r.score for r in language_model.score_with(other, model).collect()}
    want = {r.doc_id: plain_score(r.text, *plain) for r in other.collect()}
    # a probe errs on a few n-grams in a thousand, always upwards
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) <= 0.02 * abs(want[d]) for d in want)
    assert sum(got.values()) == pytest.approx(sum(want.values()), rel=0.01)
    # without its bits the model knows nothing: the scores are those of unseen n-grams
    blank = str(tmp_path / "blank")
    spark.read.parquet(f"{path}/blocks").withColumn("bits", F.when(F.col("bits").isNotNull(), F.unhex(F.repeat(F.lit("00"), 64)))).write.parquet(f"{blank}/blocks")
    spark.read.parquet(f"{path}/about").write.parquet(f"{blank}/about")
    dark = language_model.score_with(other, language_model.StoredModel.load(spark, blank)).collect()
    n, v = model.n, model.v
    for r in dark:
        assert r.score == pytest.approx(r.n_tokens * math.log10((1 - language_model.BIGRAM_WEIGHT) * 0.5 / (n + 0.5 * (v + 1))))
        assert r.score < got[r.doc_id]


def test_the_query_scores_by_the_stored_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    train = docs.where(~queries.id_crc_is("doc_id", 5, 1))
    plain = plain_model([r.text for r in train.collect()])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op9_language_model(spark, SF).collect():
        want = plain_score(texts[r.doc_id], *plain)
        assert abs(r.score - want) <= 0.02 * abs(want)


# ---- 3: loose forms that the training variants don't have

def loose_forms(rng):
    """Kind and text of personal data written in ways of its own."""
    def numerals(n):
        return "".join(rng.choices("0123456789", k=n))

    def word(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))

    first = f"{rng.choice('3456')}{numerals(14)}"
    card = first + str(-pii._luhn_sum(first + "0") % 10)
    a, b, c = rng.choice("23456789") + numerals(2), rng.choice("23456789") + numerals(2), numerals(4)
    ip = [str(rng.randrange(1, 255)) for _ in range(4)]
    return [("email", rng.choice([f"{word(6)}.{word(3)}(at){word(5)}[dot]co(dot)uk", f"{word(4)} [at]{word(4)}.{word(4)} dot org",
                                  f"{word(7)}_{word(2)} at {word(5)}-{word(3)} dot {word(4)} (dot) net"])),
            ("ip", rng.choice([f"{ip[0]}. {ip[1]} .{ip[2]} . {ip[3]}", f"{ip[0]} .{ip[1]}. {ip[2]} .{ip[3]}"])),
            ("card", rng.choice([f"{card[:4]}. {card[4:8]}. {card[8:12]}. {card[12:]}", f"{card[:4]}-{card[4:8]}  {card[8:12]}-{card[12:]}"])),
            ("phone", rng.choice([f"{a}/{b}-{c}", f"({a}){b}/{c}", f"{a} . {b} . {c}"]))]


def test_recall_and_precision_on_planted_loose_forms(spark):
    rng = random.Random(5)
    rows, planted = [], {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        text, cuts = r.text, [m.start() for m in re.finditer(r"(?<=[a-z]) (?=[a-z])", r.text)]
        if r.doc_id % 4 == 0 and len(cuts) >= 40:  # from the end on, a few words apart
            for at, (kind, form) in zip(sorted(rng.sample(cuts[::8], 4), reverse=True), loose_forms(rng), strict=True):
                text = f"{text[:at]} {form}{text[at:]}"
                planted.setdefault(r.doc_id, []).append((kind, form))
        rows.append((r.doc_id, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts, hit, wrong, total = dict(rows), Counter(), Counter(), Counter(k for p in planted.values() for k, _ in p)
    found = pii.find_personal_data(docs, pii.fit(docs)).collect()
    for r in found:
        forms = planted.get(r.doc_id, [])
        for span in set(r.spans) - set(r.strict):
            kind, lo, hi = span.split(":")
            got = texts[r.doc_id][int(lo):int(hi)]
            if (kind, got) in forms:
                hit[kind] += 1
            elif not any(got in f for _, f in forms):
                wrong[kind] += 1
    for kind in pii.KINDS:
        assert hit[kind] >= 0.9 * total[kind], (kind, hit, total, wrong)
        assert hit[kind] >= 0.9 * (hit[kind] + wrong[kind]), (kind, hit, total, wrong)


# ---- 1: cost is the rule's, not the job's; 6: memory of a long text; 7: partitions by rows

def test_a_dear_rule_goes_last(spark):
    docs = spark.range(400).select(F.concat_ws(" ", F.array_repeat(F.concat(F.lit("w"), "id"), 200)).alias("text"))
    dear = quality.Rule("a_dear", lambda m: F.size(F.filter(m.words, lambda x: F.sha2(F.sha2(F.sha2(F.repeat(x, 50), 512), 512), 512) == "")) == 0)
    cheap = quality.Rule("b_cheap", lambda m: F.length(m.text) > 0)
    idle = quality.Rule("c_idle", lambda m: F.length(m.text) < 0)
    for rules in ((dear, cheap, idle), (idle, cheap, dear)):
        assert [r.name for r in quality.order_rules(docs, "text", rules)] == ["b_cheap", "a_dear", "c_idle"]


def test_parts_of_a_long_text_add_up():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeÄéß ñ", k=rng.randint(1, 9))) for _ in range(40_000)]
    long = "\u2003".join(words) + " " + "x" * 3000
    whole, has = language_id.text_vectors([long, None, "b c"])
    size, language_id.SLICE_CHARS = language_id.SLICE_CHARS, 5000
    try:
        parts, owner = language_id._cut([long, None, "b c"])
        assert len(parts) > 30 and max(map(len, filter(None, parts))) < 5000 + 3100 and owner[-1] == 2
        again, there = language_id.text_vectors([long, None, "b c"])
    finally:
        language_id.SLICE_CHARS = size
    assert (whole == again).all() and has.tolist() == there.tolist() == [True, False, True]


def test_a_text_of_sixty_megabytes_needs_little_memory():
    code = ("import resource, sys; sys.path.insert(0, sys.argv[1])\n"
            "from panelgap.llm.language_id import text_vectors\n"
            "text_vectors(['warm up'])\n"
            "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
            "v, has = text_vectors(['the quick brown fox jumps over it ' * 1_800_000])\n"
            "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)")
    grown = int(subprocess.run([sys.executable, "-c", code, ROOT], capture_output=True, text=True, check=True).stdout)
    assert grown < 500 * 1024


# ---- 8: branches that are alike are merged, also beside others, whatever the names beneath, at any depth

def judged(spark, tmp_path, rows, rules):
    """Verdicts by url, the same from SQL."""
    path = str(tmp_path / "urls")
    spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string").write.parquet(f"{path}/pages.parquet")
    out = urls.filter_urls(spark.read.parquet(f"{path}/pages.parquet"), rules)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/pages.parquet/*.parquet')")
    ok, why = compare(out.select("page_id", "host", "path", "rule", "verdict"), con, urls_sql(rules))
    assert ok, why
    return {rows[r.page_id]: r for r in out.collect()}


@pytest.mark.parametrize("up", ["", "2024/05/a/b/c/d/e/"])
def test_an_unlabelled_branch_joins_its_likes_beside_others(spark, tmp_path, up):
    rows = [f"http://h.org/{up}{b}/{i}.html" for b in ("spama", "spamb", "spamc", "newsa", "newsb") for i in range(30)]
    rules = [urls.UrlRule("h.org", f"/{up}{b}/", v) for b, v in (("spama", "block"), ("spamb", "block"), ("newsa", "allow"), ("newsb", "allow"))]
    got = judged(spark, tmp_path, rows, rules)
    assert {r.verdict for u, r in got.items() if "spamc" in u} == {"block"}
    assert {r.template for u, r in got.items() if "spam" in u} == {f"{up.replace('2024', '<n>').replace('05', '<n>')}*block/<n>.html"}
    assert {r.verdict for u, r in got.items() if "news" in u} == {"allow"}


def test_shapes_decide_where_names_differ(spark, tmp_path):
    rng = random.Random(3)

    def slug():
        return "-".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(2))

    rows = [f"http://h.org/{b}/{rng.randrange(10**6)}" for b in ("x1q", "kk", "pile") for _ in range(40)]
    rows += [f"http://h.org/{b}/{slug()}.html" for b in ("blog", "journal", "notes") for _ in range(40)]
    rules = [urls.UrlRule("h.org", "/x1q/", "block"), urls.UrlRule("h.org", "/kk/", "block"),
             urls.UrlRule("h.org", "/blog/", "allow"), urls.UrlRule("h.org", "/journal/", "allow")]
    got = judged(spark, tmp_path, rows, rules)
    assert {r.verdict for u, r in got.items() if "/pile/" in u} == {"block"}
    # slugs differ in every branch, their form doesn't
    assert {r.verdict for u, r in got.items() if "/notes/" in u} == {"allow"}
    assert {r.template for u, r in got.items() if "/notes/" in u} == {"*allow/*"}


def test_branches_of_other_shape_or_rate_stay_apart(spark, tmp_path):
    rows = [f"http://h.org/{b}/{i}" for b in ("aa1x", "bb2x") for i in range(50)] + [f"http://h.org/odd/img/{i}/view.php" for i in range(50)]
    rows += [f"http://h.org/mixed/{i}" for i in range(50)]
    rules = [urls.UrlRule("h.org", "/aa1x/", "block"), urls.UrlRule("h.org", "/bb2x/", "block"),
             *[urls.UrlRule("h.org", f"/mixed/{i}", "block") for i in (10, 11, 12)], *[urls.UrlRule("h.org", f"/mixed/{i}", "allow") for i in (13, 14)]]
    got = judged(spark, tmp_path, rows, rules)
    assert {r.template.split("/")[0] for u, r in got.items() if "/odd/" in u} == {"odd"}
    assert {r.template.split("/")[0] for u, r in got.items() if "/mixed/" in u} == {"mixed"}
    assert {r.verdict for u, r in got.items() if "/odd/" in u and r.rule is None} <= {"allow", "block"}


def test_urls_of_odd_rows(spark, tmp_path):
    got = judged(spark, tmp_path, [None, "", "no scheme", "http://h.org", "http://h.org/", "http://h.org//a//", "http://h.org/" + "q/" * 40],
                 [urls.UrlRule("h.org", "/a", "block")])
    assert len(got) == 7 and {r.verdict for r in got.values()} <= {"allow", "block"}
    odd = spark.createDataFrame([(1, "http://h.org/x", "s", 1, 2)], "page_id long, url string, host string, n int, template int")
    assert urls.filter_urls(odd, []).count() == 1 and urls.filter_urls(odd.limit(0), []).count() == 0


# ---- 3: all candidates of the corpus are learnt from

def test_trees_learn_from_every_candidate(spark, monkeypatch):
    texts = [f"n{i}@b.cd;" + ";".join(f"21255{i:03d}{j:02d}" for j in range(80)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    learnt = docs.where(F.pmod(F.xxhash64("text"), F.lit(4)) != 3).count()
    given, fit = [], pii.BoostedTrees.fit

    def spy(self, table, *rest):
        given.append(table)
        return fit(self, table, *rest)

    monkeypatch.setattr(pii.BoostedTrees, "fit", spy)
    pii.fit(docs)
    rows = given[0].agg(F.sum(F.col("n") - F.col("y"))).first()[0] if hasattr(given[0], "agg") else len(given[0])
    assert 80 * learnt > 20_000 and rows >= 80 * learnt


def plain_boosting(x, y, rounds, rate=0.3):
    """Depth-two trees on single rows: the predictions for them."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[:-1])) for j in range(x.shape[1])]
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))

    def split(g, h, rows):
        best = (0.0, 0, -np.inf, *[g[rows].sum() / (h[rows].sum() + 1)] * 2)
        for j, c in ((j, c) for j in range(x.shape[1]) for c in cuts[j]):
            a, b = rows & (x[:, j] <= c), rows & (x[:, j] > c)
            own = [g[s].sum() ** 2 / (h[s].sum() + 1) for s in (a, b, rows)]
            if own[0] + own[1] - own[2] > best[0] + 1e-9:
                best = (own[0] + own[1] - own[2], j, c, *[g[s].sum() / (h[s].sum() + 1) for s in (a, b)])
        return best

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        _, j, c, *_ = split(y - p, p * (1 - p), np.full(len(y), True))
        for side in (x[:, j] <= c, x[:, j] > c):
            _, k, cut, low, high = split(y - p, p * (1 - p), side)
            score[side] += rate * np.where(x[side, k] <= cut, low, high)
    return 1 / (1 + np.exp(-score))


@pytest.mark.parametrize("parts", [1, 3])
def test_trees_over_a_table_are_those_of_its_rows(spark, parts):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, (300, 4)).astype(float)
    y = ((x[:, 0] > 17) ^ (x[:, 2] > 30)).astype(float)
    y[::11] = 1 - y[::11]
    x, y = np.repeat(x, 2, axis=0), np.repeat(y, 2)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[:-1])) for j in range(4)]
    trees = pii.BoostedTrees(rounds=6)
    trees.cuts = cuts
    rows = Counter(zip(map(tuple, trees.binned(x).tolist()), y.tolist(), strict=True))
    table = spark.createDataFrame([(list(k), n, int(n * v)) for (k, v), n in rows.items()], "x array<int>, n long, y long").repartition(parts)
    assert np.allclose(trees.fit(table, cuts).predict(x), plain_boosting(x, y, 6))


def test_index_and_probe_rows_are_never_broadcast(spark):
    """Their estimated size is that of the fingerprints, as if each were one row and not four to sixty-eight."""
    first = random.Random(4).getrandbits(62)
    dealt = spark.createDataFrame([(first ^ i << 20,) for i in range(3000)], "fp long").repartition(4, "fp")
    near = simhash.links(dealt)
    assert near.collect()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_duplicates_stage_never_broadcasts_index_or_probe_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(simhash, "connected_components", lambda edges, f=simhash.connected_components: (seen.append(edges), f(edges))[1])
    docs = spark.createDataFrame([(i, f"text number {i % 500} of many") for i in range(1000)], "doc_id long, text string")
    assert corpus_pipeline.near_duplicates(spark, docs, SF).count() <= 500
    seen[0].collect()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_duplicates_stage_broadcasts_nothing(spark, monkeypatch):
    """Not even small sides: a broadcast goes through the driver, which holds it until its garbage is collected."""
    seen, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, f=frame.checkpoint: (seen.append(self), f(self, *a))[1])
    docs = spark.createDataFrame([(i, f"text number {i % 500} of many") for i in range(1000)], "doc_id long, text string")
    seen += [corpus_pipeline.near_duplicates(spark, docs, SF), simhash.simhash_components(docs)]
    plans = []
    for df in seen:
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert len(seen) > 6 and sum("SortMergeJoin" in p for p in plans) > 4
    assert not [p for p in plans if "Broadcast" in p]
