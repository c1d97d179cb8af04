"""Loads that appear whole or not at all, refreshes of single partitions, readers of one version."""

import pytest
from pyspark.sql import functions as F

from panelgap.sources.warehouse import LoadConflict, Warehouse


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def frame(spark, n, tag):
    return spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("g"), F.lit(tag).alias("tag"), (F.col("id") / 3).alias("x"))


def tags(df):
    return {r.tag for r in df.select("tag").distinct().collect()}


def test_a_load_is_one_version_of_all_tables(spark, wh):
    assert wh.versions() == [] and wh.tables() == []
    assert wh.load({"a": frame(spark, 10, "one"), "b": frame(spark, 4, "one")}, {"a": ["g"]}) == 1
    assert wh.load({"a": frame(spark, 7, "two")}, {"a": ["g"]}) == 2
    assert wh.read("a").count() == 7 and wh.read("a", 1).count() == 10 and wh.read("b").count() == 4
    assert wh.read("a").columns == ["id", "g", "tag", "x"] and dict(wh.read("a").dtypes)["g"] == "int"
    assert wh.read("a", 1).agg(F.max("x")).first()[0] == 3.0 and wh.read("a").where("id = 1").first().x == 0.3333
    with pytest.raises(KeyError):
        wh.read("c")
    with pytest.raises(ValueError):
        wh.read("a", 9)


def test_a_load_that_dies_midway_leaves_the_tables(spark, wh):
    wh.load({"a": frame(spark, 10, "one"), "b": frame(spark, 4, "one")})
    broken = frame(spark, 50, "two").withColumn("x", F.when(F.col("id") == 49, F.raise_error(F.lit("died"))).otherwise(F.col("x")).cast("double"))
    with pytest.raises(Exception, match="died"):
        wh.load({"a": frame(spark, 20, "two"), "b": broken})
    assert wh.versions() == [1] and tags(wh.read("a")) == tags(wh.read("b")) == {"one"} and wh.read("a").count() == 10
    wh.load({"a": frame(spark, 20, "three"), "b": frame(spark, 5, "three")})
    assert (wh.read("a").count(), wh.read("b").count()) == (20, 5)


def test_killed_before_the_commit(spark, wh, monkeypatch):
    wh.load({"a": frame(spark, 3, "one")})
    monkeypatch.setattr(Warehouse, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        wh.load({"a": frame(spark, 9, "two")})
    monkeypatch.undo()
    assert wh.read("a").count() == 3
    assert len(wh.vacuum(keep=1)) == 1 and wh.read("a").count() == 3


def test_refresh_of_single_partitions(spark, wh):
    wh.load({"a": frame(spark, 9, "old")}, {"a": ["g"]})
    new = frame(spark, 30, "new").where("g = 1")
    assert wh.load({"a": new}, only_partitions=True) == 2
    got = {(r.g, r.tag): r.n for r in wh.read("a").groupBy("g", "tag").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, "old"): 3, (1, "new"): 10, (2, "old"): 3}
    assert wh.read("a", 1).count() == 9
    text = wh.read("a").where("g = 0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text
    with pytest.raises(ValueError):
        wh.load({"a": new.drop("x")}, only_partitions=True)


def test_two_loads_at_once_do_not_both_win(spark, wh):
    wh.load({"a": frame(spark, 1, "one")})
    manifest = wh.manifest()
    wh._commit(2, manifest)
    with pytest.raises(LoadConflict):
        wh._commit(2, manifest)
    assert wh.versions() == [1, 2]


def test_empty_tables_and_vacuum(spark, wh):
    for i in range(4):
        wh.load({"a": frame(spark, 0, "x"), "p": frame(spark, 0 if i == 3 else 5, f"v{i}")}, {"p": ["g"]})
    assert wh.read("a").count() == 0 and wh.read("p").count() == 0 and wh.read("p").columns == ["id", "g", "tag", "x"]
    before = wh.read("p", 3).collect()
    wh.vacuum(keep=2)
    assert wh.versions() == [3, 4] and sorted(wh.read("p", 3).collect()) == sorted(before)
    assert wh.drop("a") == 5 and wh.tables() == ["p"]


def test_views_of_one_version(spark, wh):
    wh.load({"wh_a": frame(spark, 4, "one"), "wh_b": frame(spark, 2, "one")})
    assert wh.register() == ["wh_a", "wh_b"]
    assert spark.sql("SELECT count(*) FROM wh_a JOIN wh_b USING (id)").first()[0] == 2
