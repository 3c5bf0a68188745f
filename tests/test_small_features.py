"""Overrides of parameters, unread pages, stamps taken out, images as files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireline.config import ClassifierParams, LightenParams, OcrParams, RotateParams, overridden
from quireline.operators import detections, stamps
from quireline.raster import pages, udfs
from quireline.schemas import IMAGE
from quireline.sources import files, sinks


def test_overrides(monkeypatch):
    said = {"quireline.LightenParams.long_side": "900", "quireline.LightenParams.keep_color": "TRUE", "quireline.ClassifierParams.languages": "rus, deu"}
    monkeypatch.setenv("QUIRELINE_LIGHTENPARAMS_DENOISE_H", "3.5")
    monkeypatch.setenv("QUIRELINE_LIGHTENPARAMS_LONG_SIDE", "1")
    got = overridden(LightenParams, said.get, canny_low=7)
    assert (got.long_side, got.keep_color, got.denoise_h, got.canny_low, got.canny_high) == (900, True, 3.5, 7, LightenParams().canny_high)
    assert overridden(LightenParams).long_side == 1 and overridden(LightenParams, long_side=2).long_side == 2
    assert overridden(ClassifierParams, said.get).languages == ("rus", "deu") and overridden(OcrParams) == OcrParams()
    with pytest.raises(ValueError, match="OcrParams.retries"):
        overridden(OcrParams, {"quireline.OcrParams.retries": "many"}.get)
    with pytest.raises(ValueError, match="logical or physical"):
        overridden(RotateParams, {"quireline.RotateParams.mode": "sideways"}.get)


def test_overrides_by_the_session(spark):
    spark.conf.set("quireline.OcrParams.timeout_s", "5")
    assert overridden(OcrParams, lambda k: spark.conf.get(k, None)).timeout_s == 5.0
    spark.conf.unset("quireline.OcrParams.timeout_s")


def test_unread_pages(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 0.1, 0.9, 0.5, 1.0, False)], "path string, page_no int, blur double, text_density double, roi_frac double, core_frac double, skew_deg double, is_table boolean")
    got = detections.document_metrics(detections.unread_pages(df)).first()
    assert (got.conf_iqr, got.words_count, got.text_blocks_count, got.avg_blur) == (0.0, 0, 0, 5.0)


def test_boxes_are_painted_over():
    a = np.full((20, 30, 3), (10, 200, 90), np.uint8)
    a[5:9, 6:12] = 0
    assert (pages.filled(a, [(6, 5, 6, 4)]) == (10, 200, 90)).all() and (a[5:9, 6:12] == 0).all()
    assert (pages.filled(a, [(-5, -5, 100, 100)]) == 255).all() and (pages.filled(a, [(40, 40, 3, 3)]) == a).all()
    g = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert pages.filled(g, []).tolist() == g.tolist()


def test_stamps_are_taken_out(spark):
    a = np.full((12, 12), 250, np.uint8)
    a[2:5, 2:5] = 9
    box = lambda conf: {"x": 2, "y": 2, "w": 3, "h": 3, "conf": conf}
    rows = [("a", udfs.struct(a), [box(0.9), box(None)], None), ("b", udfs.struct(a), [box(0.5)], None), ("c", udfs.struct(a), None, None), ("d", None, [box(0.9)], "broken")]
    df = spark.createDataFrame(rows, f"path string, image {IMAGE}, stamps array<struct<x:int,y:int,w:int,h:int,conf:double>>, error string")
    out = udfs.without_stamps(df)
    got = {r.path: r for r in out.collect()}
    assert {p: (r.num_stamps, r.error) for p, r in got.items()} == {"a": (1, None), "b": (0, None), "c": (0, None), "d": (0, "broken")}
    assert set(bytes(got["a"].image.data)) == {250} and bytes(got["b"].image.data) == a.tobytes()
    assert tuple(stamps.removal_summary(out).first()) == (4, 1, 1)


def test_images_as_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    gray, color = rng.integers(0, 256, (7, 5)).astype(np.uint8), rng.integers(0, 256, (4, 6, 3)).astype(np.uint8)
    rows = [("d/one.pdf", 1, udfs.struct(gray), None), ("d/one.pdf", 2, udfs.struct(color), None), ("d/bad.pdf", 1, None, "broken")]
    sinks.image_files(spark.createDataFrame(rows, f"path string, page_no int, image {IMAGE}, error string"), str(tmp_path / "out"))
    got = {r.path.rpartition("/")[2]: r.image for r in files.rasters(spark, str(tmp_path / "out")).collect()}
    assert set(got) == {"one_clean.png", "one_2_clean.png"}
    assert bytes(got["one_2_clean.png"].data) == color.tobytes() and bytes(got["one_clean.png"].data) == gray.tobytes()


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "num_stamps int, error string")
    assert tuple(stamps.removal_summary(df).first()) == (0, 0, 0) and df.select(F.lit(1)).count() == 0
