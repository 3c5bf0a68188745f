"""A saved model's judgement beside the rules'."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from quireline.ml import features, inference, search
from quireline.operators import rules

NAMES = ("avg_blur", "median_ocr_conf", "pct80")


@pytest.fixture(scope="module")
def rows(spark):
    own = [(f"d{i}.pdf", ("failed", "good", "medium")[i % 3], i % 5, 100.0 * (i % 3), 30.0 + 25 * (i % 3), 0.3 * (i % 3), None if i % 10 else "broken") for i in range(60)]
    return spark.createDataFrame(own, "path string, label string, fold int, avg_blur double, median_ocr_conf double, pct80 double, error string")


def test_saved_and_read_again(spark, rows, tmp_path):
    own = search.Assembled(rows, features=("pct80", "avg_blur"))  # the bundle's order, not the table's
    bundle = inference.Bundle(Pipeline(stages=[search.boosted(3, 0.5, 2, 3)]).fit(own.table.drop("fold")), own.labels, ["pct80", "avg_blur"])
    bundle.save(str(tmp_path / "m"))
    again = inference.load(spark, str(tmp_path / "m"))
    assert (again.labels, again.features) == (["failed", "good", "medium"], ["pct80", "avg_blur"])
    rule = F.struct(F.when(F.col("pct80") > 0.5, "good").otherwise("medium").alias("category"), F.format_string("share %.1f", "pct80").alias("reason"))
    got = {r.path: r for r in inference.inferred(rows, again, rule, "path").collect()}
    assert len(got) == 60
    for r in rows.collect():
        g = got[r.path]
        if r.error:
            assert (g.predicted, g.proba, g.category, g.reason) == (None, None, None, "broken")
        else:
            assert g.predicted == r.label == max(g.proba, key=g.proba.get) and abs(sum(g.proba.values()) - 1) < 1e-9
            assert (g.category, g.reason) == ("good" if r.pct80 > 0.5 else "medium", f"share {r.pct80:.1f}")


def test_features_that_are_missing(spark, rows):
    own = search.Assembled(features.derived(rows))
    bundle = inference.Bundle(Pipeline(stages=[search.forest(3, 2)]).fit(own.table.drop("fold")), own.labels, list(features.FEATURES))
    bare = spark.createDataFrame([("x",), ("y",)], "path string")
    got = inference.inferred(bare, bundle, F.struct(F.lit("medium").alias("category"), F.lit("none").alias("reason")), "path").collect()
    assert [r.path for r in got] == ["x", "y"] and got[0].predicted == got[1].predicted and inference.inferred(bare.limit(0), bundle, F.struct(F.lit("a").alias("category"), F.lit("b").alias("reason")), "path").count() == 0


def test_no_bundle(spark, tmp_path):
    with pytest.raises(ValueError, match="bundle"):
        inference.load(spark, str(tmp_path))
    assert rules.decide(rules.extended()) is not None
