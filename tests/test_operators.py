import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireline.functions import text as T
from quireline.ml import features, grid, models
from quireline.operators import compare, detections, ocr, orientation, reports, routing, rules

DET = "path string, page_no int, det_no int, text string, conf double, left double, top double, width double, height double"


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} string" for k in columns))


@pytest.mark.parametrize(("hyp", "ref", "want"), [("", "", 0.0), ("abc", "", 0.0), ("", "abc", 1.0), ("kitten", "sitting", 0.428571), ("привет", "привит", 0.166667), ("😀a", "a", 1.0), (None, "ab", 1.0), ("a", None, 0.0)])
def test_cer(spark, hyp, ref, want):
    assert one(spark, h=hyp, r=ref).select(T.cer(F.col("h"), F.col("r"))).first()[0] == want


def test_cer_rounds_half_even(spark):
    assert spark.sql("select bround(0.1234565D, 6) x").first()[0] == round(0.1234565, 6)


def test_names(spark):
    df = spark.createDataFrame([("d/A.b.PDF",), ("x.tif",), ("y.jpeg",), ("z",)], "p string")
    got = df.select(T.basename(F.col("p")), T.stem(F.col("p")), T.extension(F.col("p")), T.dispatch(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("A.b.PDF", "A.b", ".pdf", "split"), ("x.tif", "x", ".tif", "skip"), ("y.jpeg", "y", ".jpeg", "copy"), ("z", "z", "", "skip")]


def test_blank_is_of_any_script(spark):
    df = spark.createDataFrame([(" \t\n",), (" ",), ("a",), (None,)], "t string")
    assert [r[0] for r in df.select(T.not_blank(F.col("t"))).collect()] == [False, False, True, False]


def test_detections_of_a_page(spark):
    rows = [("a", 1, 1, "x", 90.0, 0.0, 0.0, 10.0, 10.0), ("a", 1, 2, " ", 70.0, 0.0, 15.0, 10.0, 20.0), ("a", 1, 3, "y", 80.0, 0.0, 15.0, 0.0, 5.0), ("a", 1, 4, "z", 0.0, 0.0, 0.0, 9.0, 9.0)]
    got = detections.page_text_metrics(detections.usable(spark.createDataFrame(rows, DET)), F.lit(1000.0)).first()
    assert (got.conf_med, got.conf_mean, got.words, got.text_blocks) == (80.0, 80.0, 2, 2)
    assert got.pct80 == pytest.approx(2 / 3, abs=1e-8) and got.bbox_area_text_frac == 0.3 and got.conf_iqr == 10.0
    assert (got.line_height_med, got.line_height_var, got.line_spacing_med, got.line_spacing_var) == (15.0, 25.0, 5.0, 0.0)


def test_pages_without_detections_have_zeros(spark):
    pages = spark.createDataFrame([("a", 1, 5.0, 0.1, 0.9, 0.5, 1.0, False)], "path string, page_no int, blur double, text_density double, roi_frac double, core_frac double, skew_deg double, is_table boolean")
    none = detections.page_text_metrics(detections.usable(spark.createDataFrame([], DET)), F.lit(1.0))
    got = detections.document_metrics(detections.all_pages(pages, none)).first()
    assert got.median_ocr_conf == 0.0 and got.words_count == 0 and got.roi_frac == 0.9


def test_polygon(spark):
    df = spark.sql("select array(named_struct('x',1D,'y',2D), named_struct('x',5D,'y',2D), named_struct('x',5D,'y',9D), named_struct('x',1D,'y',9D)) p, array(named_struct('x',1D,'y',2D)) q")
    got = df.select(detections.from_polygon(F.col("p")).alias("a"), detections.from_polygon(F.col("q")).alias("b")).first()
    assert tuple(got.a) == (1.0, 2.0, 4.0, 7.0) and got.b is None


MEASURES = ("roi_frac", "avg_skew_deg", "median_ocr_conf", "pct80", "avg_blur", "core_frac", "bbox_area_text_frac", "conf_iqr", "line_height_var")


@pytest.mark.parametrize("rule_set", [rules.base(), rules.extended(), rules.easy()])
def test_rules_decide_each_document_once(spark, rule_set):
    values = itertools.product((0.3, 0.9), (1.0, 13.0), (20.0, 60.0, 95.0), (0.05, 0.4, 0.9), (100.0, 900.0), (0.05, 0.5), (0.01, 0.2), (10.0, 40.0), (10.0, 150.0))
    df = spark.createDataFrame([(*v, 40, t) for v in values for t in (True, False)], ", ".join(f"{m} double" for m in MEASURES) + ", words_count int, is_table_like boolean")
    got = df.select(rules.decide(rule_set).alias("d")).select("d.category", "d.reason")
    assert got.where("category is null or reason is null").count() == 0
    assert {r[0] for r in got.distinct().collect()} >= {("trash"), ("failed"), ("medium")}


def test_tie_goes_to_the_thresholds(spark):
    assert [r[0] for r in spark.createDataFrame([(0.5, 0.5), (0.6, 0.5)], "a double, b double").select(rules.best_method(F.col("a"), F.col("b"))).collect()] == ["thresholds", "ml"]


def test_full_grid_and_first_best(spark):
    rows = spark.createDataFrame([(0.9, 95.0, 0.4, 5.0, 1.0, "good"), (0.05, 10.0, 0.01, 5.0, 1.0, "failed")], "pct80 double, median_ocr_conf double, bbox_area_text_frac double, conf_iqr double, line_height_var double, label string")
    found = grid.search(rows, grid={g: v[:2] for g, v in grid.GRID.items()})
    assert found.count() == 256 and reports.best_first(found, "accuracy", "seq").first().seq == 0


def test_reports_of_nothing(spark):
    none = spark.createDataFrame([], "correct int, category string, is_dark boolean, error string, status string")
    assert tuple(reports.accuracy(none).first()) == (0, 0, 0.0)
    assert {tuple(r) for r in reports.category_counts(none).collect()} == {(c, 0) for c in ("good", "medium", "failed", "trash")}
    assert tuple(reports.run_summary(none).first()) == (0, 0, 0)


def test_folds_are_stratified(spark):
    rows = spark.createDataFrame([(k, "a" if k % 3 else "b") for k in range(30)], "k int, label string")
    n = {(r.label, r.fold): r["count"] for r in reports.folds(rows, "label", F.col("k")).groupBy("label", "fold").count().collect()}
    assert all(n[l, f] == (4 if l == "a" else 2) for l in "ab" for f in range(5))


def test_weighted_median_of_ties(spark):
    rows = spark.createDataFrame([("g", 1.0, 1.0), ("g", 2.0, 1.0), ("g", 2.0, 1.0), ("g", 9.0, 1.0)], "k string, a double, w double")
    assert reports.weighted_median(rows, "a", "w", "k").first().weighted_median == 2.0


def test_reference_candidates_by_priority(spark):
    runs = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("c.pdf",)], "filename string")
    refs = spark.createDataFrame([("a.txt", "plain"), ("a.ref.txt", "marked"), ("b.ref.txt", "marked")], "filename string, text string")
    assert {r.filename: r.ref for r in compare.with_reference(runs, refs).collect()} == {"a.pdf": "plain", "b.pdf": "marked", "c.pdf": None}


def test_orientation(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (None, 0.9), (3, 0.51)], "c int, p double")
    assert [r[0] for r in df.select(orientation.correction(F.col("c"), F.col("p"))).collect()] == [270, 0, None, 90]


def test_routing(spark):
    df = spark.createDataFrame([("good", True, None), ("odd", False, None), ("failed", True, "E: x")], "category string, is_dark boolean, error string")
    assert [r.target for r in routing.by_category(df).collect()] == ["good", "trash", "failed"]
    assert routing.by_category(df, keep_failed=False).count() == 2
    assert [r.target for r in routing.by_brightness(df).collect()] == ["dark_documents", "normal_brightness", "normal_brightness"]
    pages = spark.createDataFrame([("a", None), ("a", False), ("b", False)], "path string, has_line boolean")
    assert {r.path: r.has_line for r in routing.line_gate(pages).collect()} == {"a": True, "b": False}


def test_retries_only_what_may_pass():
    seen, pauses = [], []

    def client(page):
        seen.append(page)
        return (500, "", "") if len(seen) < 3 else (200, "text/plain", "ok")

    assert ocr.ask(client, b"x", sleep=pauses.append) == ("text/plain", "ok") and pauses == [1.0, 2.0]
    with pytest.raises(ocr.Failed):
        ocr.ask(lambda page: (404, "", ""), b"x", sleep=pauses.append)
    assert len(pauses) == 2


def test_run_log_names_every_failed_page(spark):
    pages = spark.createDataFrame([("d", 1, "a", None), ("d", 2, None, "E: x"), ("d", 3, None, "E: y"), ("e", 1, "b", None)], "path string, page_no int, text string, error string")
    got = {r.filename: (r.status, r.error, r.text_len) for r in ocr.run_log(pages).collect()}
    assert got == {"d": ("error", "page 2: E: x; page 3: E: y", 3), "e": ("ok", None, 1)}


def test_missing_features_count_as_zero(spark):
    row = features.derived(spark.createDataFrame([(3.0, None)], "avg_blur double, pct80 double")).first()
    assert row.words_log == 0.0 and row.blur_per_word == 3.0 and row.pct80_squared == 0.0


def test_model_round_trip(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    rows = features.derived(spark.createDataFrame([(float(k), "good" if k > 10 else "failed") for k in range(20)], "avg_blur double, label string"))
    model = models.fitted(rows, LogisticRegression(featuresCol="scaled", labelCol="y", regParam=0.01))
    models.save(model, str(tmp_path))
    again, names = models.load(spark, str(tmp_path))
    got = models.predicted(again, rows, "label")
    assert tuple(names) == features.FEATURES and got.where("label = predicted").count() >= 18
    assert all(abs(sum(r.proba.values()) - 1) < 1e-6 for r in got.collect())


@given(st.text("abcdé", max_size=12), st.text("abcdé", max_size=12))
@settings(max_examples=10, deadline=None)
def test_edits_are_symmetric(spark, a, b):
    got = one(spark, a=a, b=b).select(F.levenshtein("a", "b"), F.levenshtein("b", "a"), T.cer(F.col("a"), F.col("a"))).first()
    assert got[0] == got[1] and got[2] == 0.0
