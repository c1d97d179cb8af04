"""Metrics of one job, quarantine in one pass, declared constraints, sketches."""

import pytest
from pyspark.sql import functions as F

from panelgap.operators import constraints as K
from panelgap.operators.constraints import TableRules, constraint_report, duplicate_rows, raise_on_violation
from panelgap.operators.observed import clean_and_measure
from panelgap.operators.sketch import approximate_distinct, exact_distinct, relative_bound, sketch_cube, sketch_groups
from panelgap.plans import model
from panelgap.plans.constraint_queries import STAR_RULES, planted
from panelgap.plans.load_queries import broken_export
from panelgap.plans.pipeline import CODES, raw_panel
from panelgap.plans.sql_surface import star_tables
from panelgap.sources.quarantine import LINE, split, with_faults
from tests.conftest import SF_SMALL


def counted(df, counter):
    """``df`` through a step that counts the rows that pass it."""
    def run(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


def test_metrics_come_from_the_one_job_that_writes(spark, tmp_path):
    raw = raw_panel(spark, SF_SMALL).checkpoint()
    passed = spark.sparkContext.accumulator(0)
    got = clean_and_measure(counted(raw, passed), model.entities(spark, SF_SMALL), CODES, str(tmp_path / "clean"))
    assert passed.value == raw.count() == got["n_raw"] == 624
    clean = spark.read.parquet(str(tmp_path / "clean"))
    assert got["n_clean"] == clean.count() and got["n_reliable"] == clean.where("is_reliable").count()
    assert (got["min_value"], got["max_value"]) == tuple(clean.agg(F.min("pct"), F.max("pct")).first())
    assert got["flag_none"] + got["flag_0"] + got["flag_1"] + got["flag_other"] == got["n_raw"]
    with pytest.raises(KeyError):
        clean_and_measure(raw.drop("geo"), model.entities(spark, SF_SMALL), CODES, str(tmp_path / "x"))


def test_quarantine_is_one_pass_and_loses_nothing(spark, tmp_path):
    raw = broken_export(spark, SF_SMALL).checkpoint()
    passed = spark.sparkContext.accumulator(0)
    checked = with_faults(counted(raw, passed), model.entities(spark, SF_SMALL), CODES)
    kept, faults = split(checked, str(tmp_path / "q"))
    n = kept.count()
    assert passed.value == raw.count()
    lost = faults.where("rejected").select("entity", "category_code", "column", "reason")
    assert n + spark.read.parquet(str(tmp_path / "q")).where("rejected = 'true'").count() == raw.count()
    assert {r.reason for r in lost.collect()} >= {"broken line", "unknown entity", "unlisted category"}
    assert kept.columns == [c for c in raw.columns if c != LINE]
    broken = raw.where(F.col(LINE).isNotNull())
    assert broken.count() == faults.where(F.col("column") == LINE).count() > 0


def test_a_row_with_several_faults_lists_them_all(spark):
    cols = ["geo", "ind_type", "TIME_PERIOD", "OBS_VALUE", "OBS_FLAG", LINE]
    raw = spark.createDataFrame([("XX", "ZZ", "19x8", "101.5", "q", None), ("NATION_1", "L_SEV", "1998", ":", " u ", None),
                                 (None, None, None, None, None, None), ("NATION_1", "L_SEV", None, None, "", None),
                                 ("NATION_1", None, None, None, None, "NATION_1,L_SE")], ", ".join(f"`{c}` string" for c in cols))
    got = [(r.rejected, sorted(f.reason for f in r.faults)) for r in with_faults(raw, model.entities(spark, SF_SMALL), CODES).collect()]
    assert sorted(got) == sorted([
        (True, ["not a year", "out of range", "unknown entity", "unknown flag", "unlisted category"]),
        (False, ["not a number"]), (True, ["unknown entity", "unlisted category"]), (False, []), (True, ["broken line"])])


def test_sound_tables_pass_and_planted_faults_fail(spark):
    raise_on_violation(constraint_report(star_tables(spark, SF_SMALL), STAR_RULES))
    bad = {(r.table_name, r.rule, r["columns"]): r.violations for r in constraint_report(planted(spark, SF_SMALL), STAR_RULES).collect()}
    assert bad["dim_level", "unique", "level_order"] == 2 and bad["dim_age", "primary_key", "os"] == 1
    assert bad["dim_category", "reference", "ls->dim_sex.ls"] == 4 and bad["dim_entity", "not_null", "region"] == 1
    assert bad["fact_panel", "domain", "pct BETWEEN 0 AND 100"] > 0 and bad["fact_panel", "unique", "indicator,entity,category_code"] > 0
    with pytest.raises(AssertionError, match="dim_level.unique"):
        raise_on_violation(constraint_report(planted(spark, SF_SMALL), STAR_RULES))


def test_equal_hashes_are_told_apart_by_the_key(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, None), (2, None), (3, "b"), (3, "b"), (3, "b")], "x int, y string")
    want = duplicate_rows(df, ["x", "y"]).first()[0]
    monkeypatch.setattr(K.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    assert duplicate_rows(df, ["x", "y"]).first()[0] == want == 3
    assert duplicate_rows(df, ["x", "y"], nulls_differ=False).first()[0] == 4


def test_only_hashes_of_unique_keys_travel(spark):
    df = spark.range(1000).select(F.col("id"), F.repeat(F.lit("x"), 500).alias("long"))
    plan = duplicate_rows(df, ["id", "long"])._jdf.queryExecution().toString()
    assert "xxhash64" in plan


def test_rules_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, p int")
    report = constraint_report({"t": empty, "u": empty}, {"t": TableRules(["k"], domains=["p > 0"], references={"p": ("u", "k")})})
    assert {r.violations for r in report.collect()} == {0} and report.count() == 4


def test_sketches_unite_and_keep_their_bound(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("E"), F.col("id") % 3).alias("entity"), F.element_at(F.array(F.lit("N"), F.lit("A"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("rf"),
                                      F.lit("F").alias("ls"), F.lit("O").alias("os"), F.when(F.col("id") % 5 != 0, F.col("id") % 20_000).alias("v"))
    approx = approximate_distinct(sketch_cube(sketch_groups(rows, "v", lg_k=12)))
    got = {(r.entity, r.category_code): r.approx_n for r in approx.collect()}
    want = {(r.entity, r.category_code): r.exact_n for r in exact_distinct(rows, "v").collect()}
    assert got.keys() == want.keys() and ("ALL", "L_LTD_SEV") in got
    for k, n in want.items():
        assert abs(got[k] - n) <= relative_bound(12) * n


def test_a_focus_query_opens_a_fraction_of_the_files(spark, tmp_path):
    from panelgap.sources.clustered import read_clustered, write_clustered
    df = spark.range(20_000).select(F.format_string("S%05d", "id").alias("entity"), "id")
    write_clustered(df.orderBy(F.rand(1)), str(tmp_path), ["entity"], files=16)
    one = read_clustered(spark, str(tmp_path), "entity", "S00042", "S00042")
    assert [r.id for r in one.collect()] == [42] and len(one.inputFiles()) == 1
    some = read_clustered(spark, str(tmp_path), "entity", high="S00999")
    assert some.count() == 1000 and 1 <= len(some.inputFiles()) <= 3
    assert read_clustered(spark, str(tmp_path), "entity").count() == 20_000
    assert read_clustered(spark, str(tmp_path), "entity", "T").count() == 0


def test_one_csv_file_in_order(spark, tmp_path):
    import csv

    from panelgap.sources.sinks import write_one_csv
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.concat(F.lit('a, "q"é '), F.col("id")).alias("text, with comma"))
    path = str(tmp_path / "out.csv")
    for _ in range(2):  # a second export replaces the first
        write_one_csv(df.repartition(7), path, ["k"])
    with open(path, encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f, escapechar="\\"))
    assert rows[0] == ["k", "text, with comma"] and [int(r[0]) for r in rows[1:]] == list(range(5000))
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["out.csv"]


def test_clean_panel_is_sorted_at_the_sink_only(spark):
    from panelgap.plans.pipeline import clean_panel_q
    plan = clean_panel_q(spark, SF_SMALL, sort=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan


def test_exact_counts_go_up_the_cube_as_counts_not_as_values(spark):
    """A value in groups of two entities, two levels and with null keys counts once a cell, and no value is expanded."""
    made = [("A", "N", "F", "O", 1), ("A", "A", "F", "O", 1), ("B", "R", "O", "O", 1), ("B", "R", "O", "O", 1), ("B", "A", "O", "F", 2),
            (None, "A", None, "F", 2), ("A", None, "F", "P", 3), ("A", "R", "F", "O", None), ("A", "R", "F", "P", 4)]
    rows = spark.createDataFrame(made, "entity string, rf string, ls string, os string, v long")
    df = exact_distinct(rows, "v")
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first = next((i for i, x in enumerate(plan) if "collect_set" in x), len(plan))
    assert not any("v#" in x for x in plan[:first])
    level = {"N": ["L_NONE"], "A": ["L_LTD", "L_LTD_SEV"], "R": ["L_SEV", "L_LTD_SEV"], None: [None]}
    want = {}
    for e, rf, ls, os_, v in made:
        for cell in ((x, lv, *s) for x in (e, "ALL") for lv in level[rf] for s in (("Total", "Total"), (ls, "Total"), ("Total", os_))):
            if v is not None:
                want.setdefault(cell, set()).add(v)
    assert {(r.entity, r.level, r.ls, r.os): r.exact_n for r in df.collect()} == {k: len(v) for k, v in want.items()}
