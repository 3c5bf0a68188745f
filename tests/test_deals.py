"""Tables are dealt over more tasks as they grow."""

import pytest
from pyspark.sql import functions as F

from quireline import tables
from quireline.operators import detections
from quireline.plans import catalog, pages


@pytest.mark.parametrize(("together", "least"), [(500, 12), (2000, 4)])
def test_detections_and_pages_are_dealt_by_their_number(spark, sf, monkeypatch, together, least):
    t = catalog.Tables(spark, sf)
    want = sorted(map(tuple, catalog.page_ocr_metrics(t).collect()))
    monkeypatch.setattr(tables, "TOGETHER", together)
    assert tables.tasks(t("lineitem"), t("orders")) >= least
    parts = lambda df: df.groupBy(F.spark_partition_id()).count().count()
    assert parts(detections.with_gap(detections.usable(catalog.ocr(t)), catalog.PAGE)) >= least
    assert parts(catalog.page_metrics(t)) >= least
    assert sorted(map(tuple, catalog.page_ocr_metrics(t).collect())) == want


@pytest.mark.parametrize(("together", "least"), [(100, 15), (300, 5)])
def test_pages_of_documents_are_dealt_by_their_number(spark, sf, monkeypatch, together, least):
    t, joined = catalog.Tables(spark, sf), []
    monkeypatch.setattr(tables, "TOGETHER", together)
    monkeypatch.setattr(detections, "document_metrics", lambda pages, f=detections.document_metrics: joined.append(pages) or f(pages))
    got = catalog.training_rows(t)  # topk_importance, derived_features, routed_records and the trained queries read the same documents
    assert got.count() == t("orders").select("o_custkey").distinct().count()
    assert [df.groupBy(F.spark_partition_id()).count().count() >= least for df in joined] == [True]


def test_an_empty_table_is_dealt_too(spark, sf):
    none = catalog.Tables(spark, sf)("orders").limit(0)
    assert tables.tasks(none) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["predict", "infer_documents"])
def test_documents_are_made_once(spark, sf, monkeypatch, name):
    made = []
    for module in (catalog, pages):
        monkeypatch.setattr(module, "documents", lambda t, f=module.documents: made.append(1) or f(t))
    got = catalog.QUERIES[name](spark, sf)
    assert len(made) == 1 and got.count() == catalog.documents(catalog.Tables(spark, sf)).count()
