"""The summed-area table against the rule itself, row by row, for every combination."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from quireline.ml import grid


def rule(m, c):
    p, conf, box, iqr, var = m
    if p < c["pct80_failed"] or conf < c["conf_failed"] or box < c["bbox_failed"] or (iqr > c["conf_iqr_max"] and p < 0.4):
        return "failed"
    if var > c["line_var_max"] and conf < 70:
        return "medium"
    return "good" if p >= c["pct80_good"] and conf >= c["conf_good"] and box >= c["bbox_good"] and iqr <= 25 else "medium"


# thresholds below, at and above those of the rule that aren't searched, and "good" ones below "failed" ones
ODD = {"pct80_failed": (0.1, 0.45), "pct80_good": (0.2, 0.4), "conf_failed": (40.0, 75.0), "conf_good": (60.0, 70.0), "bbox_failed": (0.05, 0.3), "bbox_good": (0.15,), "conf_iqr_max": (10.0, 25.0, 40.0), "line_var_max": (50.0, 100.0)}


@pytest.mark.parametrize("values", [ODD, {g: v[1:3] for g, v in grid.GRID.items()}])
def test_every_combination(spark, values):
    rng = random.Random(2)
    near = lambda *v: rng.choice([*v, rng.uniform(0, 2) * v[0]])
    rows = [(near(0.1, 0.2, 0.4, 0.45, 0.5), near(40.0, 60.0, 70.0, 75.0, 80.0), near(0.05, 0.15, 0.3), near(10.0, 25.0, 40.0), near(50.0, 100.0, 200.0), rng.choice(["failed", "medium", "good", "trash", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{m} double" for m in grid.MEASURES) + ", label string")
    got = {r.seq: r for r in grid.search(df, grid=values).collect()}
    every = [dict(zip(values, c, strict=True)) for c in product(*values.values())]
    assert sorted(got) == list(range(len(every)))
    for seq, c in enumerate(every):
        r = got[seq]
        assert {g: r[g] for g in values} == c and r.n == 400 and r.n_correct == sum(rule(x[:5], c) == x[5] for x in rows), c
        assert r.accuracy == pytest.approx(r.n_correct / 400)


def test_no_rows_and_nulls(spark):
    df = spark.createDataFrame([(None, 90.0, 0.5, None, 0.0, "failed")], ", ".join(f"{m} double" for m in grid.MEASURES) + ", label string")
    assert {(r.n, r.n_correct) for r in grid.search(df).select("n", "n_correct").distinct().collect()} == {(1, 1)}  # a null share passes no threshold
    assert grid.search(df.limit(0)).agg(F.max("n"), F.max("accuracy")).first() == (0, None)
