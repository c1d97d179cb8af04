"""Cleaning pipeline on a dirty raw fixture (FIXTURES B3 raw form + C3)."""

import pytest
from pyspark.errors import AnalysisException

from panelgap.operators import clean as C
from panelgap.operators.expect import check_panel, raise_on_fail
from panelgap.plans import model

RAW_COLS = list(C.RAW_RENAME) + C.RAW_UNUSED


def raw_frame(spark, rows):
    """rows: (geo, ind_type, value, flag); everything else constant."""
    full = []
    for geo, code, val, flag in rows:
        r = {c: "x" for c in RAW_COLS}
        r.update({"TIME_PERIOD": "1998", "geo": geo, "Geopolitical entity (reporting)": geo, "ind_type": code,
                  "Individual type": code, "OBS_VALUE": val, "OBS_FLAG": flag})
        full.append(tuple(r[c] for c in RAW_COLS))
    return spark.createDataFrame(full, ", ".join(f"`{c}` string" for c in RAW_COLS))


def entity_dim(spark, names=("N1", "N2")):
    return spark.createDataFrame([(n, f"name {n}", False) for n in names] + [("ALL", "all", True)],
                                 "entity string, entity_name string, is_aggregate boolean")


CODES = ["L_NONE", "L_SEV", "GF_L_SEV", "BP_L_SEV"]


def test_clean_chain(spark):
    raw = raw_frame(spark, [
        ("N1", "L_NONE", "61.5", None), ("N1", "L_SEV", "55.0", " u "), ("N1", "GF_L_SEV", None, "u"),
        ("N1", "BP_L_SEV", "59.25", "u"), ("N2", "L_NONE", "60", ""), ("N2", "L_SEV", "58.5", None),
        ("N2", "GF_L_SEV", "57.1", None), ("N2", "BP_L_SEV", "56.0", None),
        ("ZZ", "L_NONE", "50.0", None),                 # entity outside the target list
        ("N1", "XX_L_NONE", "50.0", None),              # code outside the list
        ("ALL", "L_NONE", "60.0", None),
    ])
    out = C.clean_panel(raw, entity_dim(spark), CODES)
    rows = {(r.entity, r.category_code): r for r in out.collect()}
    assert len(rows) == 9
    assert ("ZZ", "L_NONE") not in rows and ("N1", "XX_L_NONE") not in rows
    r = rows[("N1", "L_SEV")]
    assert r.quality_flag == "u" and r.is_reliable is False and r.pct == 55.0
    r = rows[("N1", "GF_L_SEV")]
    assert r.pct is None and r.is_reliable is False and (r.ls, r.os) == ("F", "Total")
    r = rows[("N2", "L_NONE")]
    assert r.quality_flag is None and r.is_reliable is True and r.pct == 60.0
    assert rows[("N1", "BP_L_SEV")].os == "P" and rows[("N1", "BP_L_SEV")].level_label == "Returned R"
    assert rows[("N1", "L_NONE")].entity_name == "name N1"
    assert dict(out.dtypes)["year"] == "int" and dict(out.dtypes)["is_reliable"] == "boolean"


def test_load_and_clean_keeps_all_rows_and_padded_flags(spark):
    raw = raw_frame(spark, [("N1", "L_SEV", "55.0", " u "), ("N1", "GF_L_SEV", "54.0", "u"), ("ZZ", "L_NONE", "50.0", None),
                            ("N2", "XX_L_NONE", None, None), ("N2", "L_NONE", ":", "")])
    out = C.load_and_clean(raw, entity_dim(spark), {"L_SEV": "severe", "L_NONE": "none"})
    rows = {(r.entity, r.category_code): r for r in out.collect()}
    assert len(rows) == 5 and out.columns == C.CLEAN_COLUMNS
    r = rows["N1", "L_SEV"]  # not stripped, so not the flag
    assert (r.quality_flag, r.is_reliable, r.pct, r.level_label) == (" u ", True, 55.0, "severe")
    r = rows["N1", "GF_L_SEV"]
    assert (r.quality_flag, r.is_reliable, r.ls, r.entity_name) == ("u", False, "F", "name N1")
    assert rows["ZZ", "L_NONE"].entity_name is None and rows["N2", "XX_L_NONE"].level_label == "XX_L_NONE"
    assert rows["N2", "XX_L_NONE"].is_reliable is False
    r = rows["N2", "L_NONE"]
    assert (r.pct, r.quality_flag, r.is_reliable) == (None, None, True)


def test_age_dimension_has_bounds_and_issues(spark):
    rows = {r.os: r for r in model.dim_age(spark).collect()}
    assert {k for k, r in rows.items() if r.has_data_issues} == {"F"}
    assert all(r.age_min is None and r.age_max is None for r in rows.values()) and len(rows) == 4


def test_malformed_value_order(spark):
    """D4: ':' becomes NULL; flagged unreliable by default, reliable in legacy order."""
    raw = raw_frame(spark, [("N1", "L_NONE", ":", None)])
    new = C.clean_panel(raw, entity_dim(spark), CODES).collect()[0]
    old = C.clean_panel(raw, entity_dim(spark), CODES, legacy_order=True).collect()[0]
    assert new.pct is None and new.is_reliable is False
    assert old.pct is None and old.is_reliable is True


def test_missing_required_column(spark):
    raw = raw_frame(spark, [("N1", "L_NONE", "1", None)]).drop("OBS_FLAG")
    with pytest.raises(KeyError):
        C.select_rename(raw)


def test_decoder_reference_preset(spark):
    """C3 decoder cases with the reference's prefixes (sex first, then age)."""
    sex = {"F_": "Female", "M_": "Male"}
    age = {"Y16_24_": "16-24", "Y25_54_": "25-54", "Y55_74_": "55-74"}
    labels = {"DIS_NONE": "No disability", "DIS_SEV": "Severely limited", "DIS_LTD": "Limited (not severely)"}
    df = spark.createDataFrame([(c,) for c in ["DIS_NONE", "F_DIS_SEV", "Y25_54_DIS_SEV", "M_Y55_74_DIS_LTD",
                                               "Y65_99_DIS_SEV", "XYZ"]], "category_code string")
    out = {r.category_code: (r.level_label, r.ls, r.os)
           for r in C.decode_category(df, sex_prefixes=sex, age_prefixes=age, level_labels=labels).collect()}
    assert out["DIS_NONE"] == ("No disability", "Total", "Total")
    assert out["F_DIS_SEV"] == ("Severely limited", "Female", "Total")
    assert out["Y25_54_DIS_SEV"] == ("Severely limited", "Total", "25-54")
    assert out["M_Y55_74_DIS_LTD"] == ("Limited (not severely)", "Male", "55-74")
    assert out["Y65_99_DIS_SEV"] == ("Y65_99_DIS_SEV", "Total", "Total")
    assert out["XYZ"] == ("XYZ", "Total", "Total")


def test_na_tokens_and_csv_roundtrip(spark, tmp_path):
    from panelgap.sources.csv import read_raw_csv
    from panelgap.sources.sinks import write_csv
    raw = raw_frame(spark, [("NA", "L_NONE", "NaN", "u"), ("N1", "L_SEV", "n/a", None), ("N2", "L_SEV", "12.5", "")])
    path = str(tmp_path / "raw_csv")
    write_csv(raw, path)
    back = read_raw_csv(spark, path)
    rows = {r["geo"]: r for r in back.collect()}
    assert "NA" in rows                       # a code column keeps 'NA'
    assert rows["NA"]["OBS_VALUE"] is None and rows["N1"]["OBS_VALUE"] is None
    assert rows["N2"]["OBS_VALUE"] == "12.5"
    with pytest.raises(AnalysisException):
        read_raw_csv(spark, str(tmp_path / "missing.csv"))


def test_expectations_report_violations(spark):
    from panelgap.config import NULL_CATEGORY
    panel = spark.createDataFrame([
        ("N1", "L_NONE", 101.5, None, True), ("N1", "L_SEV", None, "u", False),
        ("N1", "L_SEV", 50.0, None, True),            # duplicate key
        ("N2", "L_NONE", 40.0, "x", True), ("N9", "L_NONE", 1.0, None, True),
    ], "entity string, category_code string, pct double, quality_flag string, is_reliable boolean")
    cats = spark.createDataFrame([(c,) for c in ["L_NONE", "L_SEV"]], "category_code string")
    res = {r.check_name: r.violations for r in
           check_panel(panel, entity_dim(spark), cats, n_categories=2,
                       allowed_null_categories=[NULL_CATEGORY]).collect()}
    assert res["E4_value_range"] == 1
    assert res["E5_null_categories"] == 1
    assert res["E6_unique_key"] == 1
    assert res["E7_fk_entity"] == 1
    assert res["E8_flag_domain"] == 1
    assert res["E1_row_count"] == 1          # 5 rows vs 3 entities x 2 categories
    assert res["E3_reliable_is_boolean"] == 0
    with pytest.raises(AssertionError):
        raise_on_fail(check_panel(panel, entity_dim(spark), cats, 2, [NULL_CATEGORY]))


def test_range_report_and_profile(spark):
    df = spark.createDataFrame([(1.0,), (101.5,), (None,), (-2.0,)], "pct double")
    r = C.range_report(df).collect()[0]
    assert (r.n_out_of_range, r.min_value, r.max_value) == (2, -2.0, 101.5)
    raw = raw_frame(spark, [("N2", "L_NONE", ":", "u"), ("N1", "L_NONE", "1", None), ("N1", "L_SEV", "2", None)])
    prof, hist = C.profile_raw(raw)
    p = prof.collect()[0]
    assert p.n_unparsed == 1 and p.entities == ["N1", "N2"]
    h = {r.flag: r.n for r in hist.collect()}
    assert h == {"u": 1, None: 2}


def test_typed_csv_reader(spark, tmp_path):
    """Explicit schema (no inference); a malformed number becomes NULL."""
    from panelgap.sources.csv import read_typed_csv
    p = tmp_path / "typed.csv"
    p.write_text("entity,gap_total,pct_sev\nN1,1.5,60.25\nN2,:,59.0\n")
    df = read_typed_csv(spark, str(p), "entity string, gap_total double, pct_sev double")
    rows = {r.entity: r for r in df.collect()}
    assert rows["N1"].gap_total == 1.5 and rows["N2"].gap_total is None and rows["N2"].pct_sev == 59.0


def test_distinct_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "g string")
    assert [r.g for r in C.distinct_sorted(df, "g").collect()] == ["a", "b"]
