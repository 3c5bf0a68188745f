"""Queries run over the operators' whole job."""

import math

from quireline.ml import grid, search
from quireline.plans import catalog, pages
from quireline.raster import synthetic


def test_the_whole_grid(spark, sf):
    assert catalog.QUERIES["threshold_grid"](spark, sf).count() == math.prod(map(len, grid.GRID.values())) == 65_536


def test_every_fold_is_scored(spark, sf, monkeypatch):
    asked = []
    scored = spark.createDataFrame([(0, "a", 0, 1, 1, 0.0)], search.RESULTS)
    monkeypatch.setattr(search, "searched", lambda rows, results, candidates: asked.append((rows.folds, list(candidates))) or scored)
    for name in ("train_rf", "train_lr", "train_gbt_ovr", "train_svm", "model_search"):
        catalog.QUERIES[name](spark, sf)
    assert asked == [([0, 1, 2, 3, 4], names) for names in (["rf_50_5"], ["lr_1"], ["gb_50_4"], ["svm"], list(search.CANDIDATES))] and len(search.CANDIDATES) == 13


def test_every_drawn_page_is_deskewed(spark, sf):
    assert {r.path for r in catalog.QUERIES["deskew"](spark, sf).select("path").collect()} == set(synthetic.drawn())


def test_every_drawn_page_is_lightened_by_default_parameters(spark, sf, monkeypatch):
    asked = []
    monkeypatch.setattr(pages.udfs, "lightened", lambda df, *more: asked.append(({r.path for r in df.select("path").collect()}, more)) or df)
    catalog.QUERIES["lighten"](spark, sf)
    assert asked == [(set(synthetic.drawn()), ())]
