"""Exact ranks and folds over ranges."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quireline import tables
from quireline.operators import ranks, reports


def rows():
    rng = random.Random(8)
    return [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(900)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "label string, v int, i int").repartition(7)


def before(v):
    return (v is not None, v or 0)


def test_one_order(frame):
    got = sorted((r["rank"], r.v, r.i, r.n) for r in ranks.ranked(frame, "v", "i", total="n").collect())
    want = sorted(rows(), key=lambda r: (before(r[1]), r[2]))
    assert got == [(k, v, i, 900) for k, (_, v, i) in enumerate(want)]


def test_by_label_and_ties(frame):
    got = ranks.ranked(frame, "v", by=("label",), total="n").collect()
    sizes = Counter(r[0] for r in rows())
    for label, n in sizes.items():
        own = sorted((r["rank"], r.v) for r in got if r.label == label)
        assert [k for k, _ in own] == list(range(n)) and [v for _, v in own] == sorted((r[1] for r in rows() if r[0] == label), key=before)
    assert {(r.label, r.n) for r in got} == set(sizes.items())


def test_no_window_over_rows(spark, frame):
    """Rows are sorted within ranges; windows are over counts of ranges alone, and no label is one task's."""
    out = ranks.ranked(frame, "i", by=("label",))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    tasks = {r["t"]: r["count"] for r in out.where("label = 'hot'").groupBy(F.spark_partition_id().alias("t")).count().collect()}
    assert sum(tasks.values()) == sum(r[0] == "hot" for r in rows())


def test_offsets_by_shuffle(frame, monkeypatch):
    want = Counter(map(tuple, ranks.ranked(frame, "i", by=("label",)).collect()))
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, ranks.ranked(frame, "i", by=("label",)).collect())) == want


def test_empty(spark, frame):
    assert ranks.ranked(frame.limit(0), "v", by=("label",), total="n").collect() == []
    assert reports.numbered(spark.createDataFrame([], "name string")).collect() == []


def test_folds_and_numbers(frame):
    got = reports.folds(frame, "label", F.struct("v", "i")).collect()
    for label in {r[0] for r in rows()}:
        own = sorted(((r.v, r.i, r.fold) for r in got if r.label == label), key=lambda r: (before(r[0]), r[1]))
        assert [f for _, _, f in own] == [k % 5 for k in range(len(own))]
    few = frame.where("i < 30").select(F.format_string("n%02d", "i").alias("name"))
    assert sorted((r.name, r.i, r.n, r.remaining) for r in reports.numbered(few).collect()) == [(f"n{k:02d}", k + 1, 30, 29 - k) for k in range(30)]


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    with pytest.raises(RuntimeError, match="checkpoint"):
        tables.shared_folder(type("Session", (), {"sparkContext": Context()})())
