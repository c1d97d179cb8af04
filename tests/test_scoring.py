"""The encoder and the scorer as artefacts; profiles outside the sample."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelgap.ml.sample import FEATURES
from panelgap.ml.scoring import CodeEncoder, CodeEncoderModel, fit_scorer, score_profiles
from panelgap.plans import model
from panelgap.plans.ml_queries import PROFILES, named_profiles
from tests.conftest import SF_MID, SF_SMALL


def test_codes_equal_the_samples(spark):
    ml = model.ml_frame(spark, SF_SMALL)
    enc = CodeEncoder(inputCols=list(FEATURES), outputCols=[f"{c}_new" for c in FEATURES]).fit(ml)
    got = enc.transform(ml)
    assert got.count() == ml.count()
    for c in FEATURES:
        assert got.where(F.col(f"{c}_new") != F.col(f"{c}_code")).count() == 0


@pytest.mark.parametrize(("rule", "rows"), [("keep", 3), ("skip", 1), ("error", None)])
def test_unknown_and_null_values(spark, rule, rows):
    enc = CodeEncoder(inputCols=["a"], outputCols=["k"], handleInvalid=rule).fit(spark.createDataFrame([("y",), ("x",), (None,)], "a string"))
    new = enc.transform(spark.createDataFrame([("x",), ("q",), (None,)], "a string"))
    if rows is None:
        with pytest.raises(Exception, match="unknown value"):
            new.collect()
    else:
        assert {r.a: r.k for r in new.collect()} == ({"x": 0, "q": 2, None: 2} if rule == "keep" else {"x": 0})


def test_save_and_load_encoder(spark, tmp_path):
    enc = CodeEncoder(inputCols=["a"], outputCols=["k"], handleInvalid="keep").fit(spark.createDataFrame([("b",), ("a",)], "a string"))
    enc.write().overwrite().save(str(tmp_path / "e"))
    again = CodeEncoderModel.load(str(tmp_path / "e"))
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "a string")
    assert again.uid == enc.uid and again.getHandleInvalid() == "keep"
    assert sorted(enc.transform(rows).collect()) == sorted(again.transform(rows).collect())


def test_reloaded_scorer_gives_the_same_scores(spark, tmp_path):
    ml = model.ml_frame(spark, SF_SMALL)
    scorer = fit_scorer(ml, ml.where(~F.col("is_test")), FEATURES)
    grid = (ml.select("entity").distinct().union(spark.createDataFrame([("NOWHERE",)], "entity string"))
            .join(model.dim_category(spark).select("category_code", "level", "ls", "os"), F.lit(True)))
    scorer.save(str(tmp_path / "scorer"))
    again = PipelineModel.load(str(tmp_path / "scorer"))
    a, b = (sorted(score_profiles(s, grid).collect()) for s in (scorer, again))
    assert a == b and len(a) == grid.count() and all(0 <= r.prob_pos <= 1 for r in a)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_every_named_profile_has_a_score(spark, sf):
    got = named_profiles(spark, sf).collect()
    assert {(r.entity, r.category_code) for r in got} == set(PROFILES) and len(got) == len(PROFILES)
    assert all(0 <= r.prob_pos <= 1 and r.prediction in (0, 1) for r in got)
