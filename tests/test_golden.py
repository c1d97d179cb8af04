"""Published values of the reference (entity table, gender, clusters) run
through the same operators, on tiny frames."""

import pytest
from pyspark.sql import functions as F

from panelgap.config import PanelSpec
from panelgap.operators.metrics import entity_metrics
from panelgap.operators.rank import rank_by, rank_where

# Published (reference level, severe level) per entity.
PUBLISHED = [
    ("LT", 93.31, 57.45), ("IT", 92.88, 74.61), ("ES", 97.56, 79.30), ("EU27_2020", 95.22, 82.29),
    ("DE", 95.58, 84.53), ("FR", 96.24, 86.88), ("PT", 91.73, 84.47), ("SE", 99.15, 94.43),
    ("NL", 99.72, 98.67),
]
GAPS = {"LT": 35.86, "IT": 18.27, "ES": 18.26, "EU27_2020": 12.93, "DE": 11.05, "FR": 9.36,
        "PT": 7.26, "SE": 4.72, "NL": 1.05}
VS_BENCH = {"LT": 22.93, "IT": 5.34, "ES": 5.33, "DE": -1.88, "FR": -3.57, "PT": -5.67,
            "SE": -8.21, "NL": -11.88}
SPEC = PanelSpec(aggregate_entity="EU27_2020", focus_entity="ES")


def published_fact(spark, extra=()):
    rows = []
    for e, none, sev in PUBLISHED:
        agg = e == "EU27_2020"
        rows.append((e, agg, "L_NONE", "L_NONE", "Total", "Total", none, True))
        rows.append((e, agg, "L_SEV", "L_SEV", "Total", "Total", sev, True))
    rows += list(extra)
    return spark.createDataFrame(
        rows, "entity string, is_aggregate boolean, category_code string, level string, ls string, os string, "
              "pct double, is_reliable boolean")


def test_gaps_ranks_and_benchmark(spark):
    m = {r.entity: r for r in entity_metrics(published_fact(spark), SPEC, low=5, high=30).collect()}
    for e, g in GAPS.items():
        assert abs(m[e].gap_total - g) < 0.01
    for e, d in VS_BENCH.items():
        assert abs(m[e].gap_vs_bench - d) < 0.011
    assert m["EU27_2020"].gap_vs_bench == 0.0
    assert [e for e, _ in sorted(((e, r.rank_by_gap) for e, r in m.items() if r.rank_by_gap),
                                 key=lambda x: x[1])][:3] == ["LT", "IT", "ES"]
    assert m["EU27_2020"].rank_by_gap is None
    assert m["EU27_2020"].inclusion_group is None
    assert m["LT"].inclusion_group == "Extreme case"
    assert m["NL"].inclusion_group == "High inclusion" and m["SE"].inclusion_group == "High inclusion"
    assert m["ES"].inclusion_group == "Medium inclusion"
    # excluded share at the severe level
    assert abs(m["ES"].pct_excluded_sev - 20.70) < 1e-9


def test_distance_to_leaders_uses_arithmetic_not_comment(spark):
    # Improvement of the focus to the benchmark is 82.29 - 79.30 = 2.99
    f = {e: (a, b) for e, a, b in PUBLISHED}
    assert round(f["EU27_2020"][1] - f["ES"][1], 2) == 2.99
    assert round(f["NL"][1] - f["ES"][1], 2) == 19.37
    assert round(f["SE"][1] - f["ES"][1], 2) == 15.13


def test_rank_modes(spark):
    df = spark.createDataFrame([(e, GAPS[e], e == "EU27_2020") for e in GAPS], "entity string, gap double, agg boolean")
    w1 = {r.entity: r.r for r in rank_by(df, "gap", out="r").collect()}
    assert w1["EU27_2020"] == 4 and w1["LT"] == 1 and w1["NL"] == 9          # aggregate counted
    w2 = {r.entity: r.r for r in rank_where(df, ~F.col("agg"), "gap", "r").collect()}
    assert w2["EU27_2020"] is None and w2["DE"] == 4 and w2["NL"] == 8       # aggregate skipped


def test_missing_benchmark_gives_null(spark):
    fact = published_fact(spark).where(F.col("entity") != "EU27_2020")
    m = entity_metrics(fact, SPEC).collect()
    assert all(r.gap_vs_bench is None for r in m)


def test_null_cell_present_vs_absent(spark):
    # a present cell with NULL value keeps the row (NULL gap); an absent cell drops it
    from panelgap.operators.metrics import cell_pivot
    fact = published_fact(spark, extra=[("XX", False, "L_NONE", "L_NONE", "Total", "Total", 90.0, True),
                                        ("XX", False, "L_SEV", "L_SEV", "Total", "Total", None, False),
                                        ("YY", False, "L_NONE", "L_NONE", "Total", "Total", 90.0, True)])
    p = {r.entity: r for r in cell_pivot(fact, {"a": "L_NONE", "b": "L_SEV"}, require=("a", "b")).collect()}
    assert "XX" in p and p["XX"].b is None and p["XX"].b_rel is False
    assert "YY" not in p


def test_cluster_partition_on_published_points(spark):
    """The eight published points: the best of 10 restarts is the CSV's
    partition {LT} {IT,ES,DE,FR,PT} {SE,NL}; population-std cost 1.827."""
    from panelgap.ml.cluster import kmeans_restarts, relabel_by_mean, silhouette_euclid, standardize
    pts = [(e, GAPS[e], s) for e, _, s in PUBLISHED if e != "EU27_2020"]
    df = standardize(spark.createDataFrame(pts, "entity string, gap_total double, pct_sev double"),
                     ["gap_total", "pct_sev"])
    m, cost, vec = kmeans_restarts(df, ["gap_total_z", "pct_sev_z"], 3)
    assert cost == pytest.approx(1.827, abs=2e-3)
    got = silhouette_euclid(m.transform(vec), ["gap_total_z", "pct_sev_z"], "cluster_raw", "entity")
    assert got.first()[0] == pytest.approx(0.441, abs=1e-3)
    lab = {r.entity: r.cluster for r in relabel_by_mean(m.transform(vec), "gap_total").collect()}
    assert lab["LT"] == 2 and lab["SE"] == lab["NL"] == 0
    assert {lab[e] for e in ("IT", "ES", "DE", "FR", "PT")} == {1}


def test_require_reliable_modes(spark):
    from panelgap.operators.metrics import cell_pivot, require_reliable
    fact = published_fact(spark, extra=[("XX", False, "L_NONE", "L_NONE", "Total", "Total", 90.0, False),
                                        ("XX", False, "L_SEV", "L_SEV", "Total", "Total", 80.0, True),
                                        ("YY", False, "L_NONE", "L_NONE", "Total", "Total", 90.0, True),
                                        ("YY", False, "L_SEV", "L_SEV", "Total", "Total", 70.0, False)])
    piv = cell_pivot(fact, {"a": "L_NONE", "b": "L_SEV"}, require=("a", "b"))
    ents = {m: {r.entity for r in require_reliable(piv, m, "a", "b").collect()} & {"XX", "YY"}
            for m in ("none", "right", "both")}
    assert ents == {"none": {"XX", "YY"}, "right": {"XX"}, "both": set()}
    with pytest.raises(ValueError):
        require_reliable(piv, "left", "a", "b")
