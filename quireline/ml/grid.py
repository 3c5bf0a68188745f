"""Threshold search: every combination of the grid against all rows, by a summed-area table.

A rule asks a row only which thresholds its five measures pass, so rows are counted by these levels: at most as many cells as
the thresholds make, whatever the rows. Summed along all five axes, the cells say how many rows pass any five thresholds,
and what a combination judges right is a sum of a few of these numbers: rows that pass some thresholds and not others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The grid.
GRID = {
    "pct80_failed": (0.10, 0.15, 0.20, 0.25),
    "pct80_good": (0.50, 0.60, 0.70, 0.80),
    "conf_failed": (30.0, 40.0, 50.0, 60.0),
    "conf_good": (70.0, 80.0, 85.0, 90.0),
    "bbox_failed": (0.02, 0.05, 0.08, 0.10),
    "bbox_good": (0.15, 0.20, 0.25, 0.30),
    "conf_iqr_max": (20.0, 30.0, 40.0, 50.0),
    "line_var_max": (50.0, 100.0, 150.0, 200.0),
}


MEASURES = ("pct80", "median_ocr_conf", "bbox_area_text_frac", "conf_iqr", "line_height_var")
LABELS = ("failed", "medium", "good")
# Thresholds of the rule that aren't searched.
LOW_PCT80, LOW_CONF, GOOD_IQR = 0.4, 70.0, 25.0


def _cuts(grid: dict[str, tuple[float, ...]]) -> list[list[float]]:
    """For each measure all thresholds that it is held against, ascending; a level is how many of them a row passes."""
    own = (("pct80_failed", "pct80_good", LOW_PCT80), ("conf_failed", "conf_good", LOW_CONF), ("bbox_failed", "bbox_good"), ("conf_iqr_max", GOOD_IQR), ("line_var_max",))
    return [sorted({float(v) for x in names for v in (grid[x] if isinstance(x, str) else (x,))}) for names in own]


def _level(measure: str, cuts: list[float]) -> Column:
    """The first three measures pass a threshold from it on, the others beyond it; a null one passes none."""
    c = F.col(measure)
    passes = (c > v if measure in MEASURES[3:] else c >= v for v in cuts)
    return sum((F.coalesce(p.cast("int"), F.lit(0)) for p in passes), F.lit(0))


def passing(rows: DataFrame, label: str, grid: dict[str, tuple[float, ...]]) -> tuple[np.ndarray, int]:
    """([label, level, ...] -> rows of the label whose levels are at least these, all rows). The driver gets a row a label and occupied cell."""
    cuts = _cuts(grid)
    number = F.coalesce(F.array_position(F.array(*map(F.lit, LABELS)), F.col(label)), F.lit(0))
    cells = rows.groupBy(number.alias("label"), *(_level(m, c).alias(f"level{k}") for k, (m, c) in enumerate(zip(MEASURES, cuts, strict=True)))).agg(F.count("*").alias("n")).toPandas()
    counts = np.zeros((len(LABELS) + 1, *(len(c) + 1 for c in cuts)), np.int64)
    np.add.at(counts, tuple(cells[c].to_numpy().astype(int) for c in cells.columns[:-1]), cells["n"].to_numpy())
    for axis in range(1, 6):
        counts = np.flip(np.cumsum(np.flip(counts, axis), axis), axis)
    return counts[1:], int(cells["n"].sum())


def _box(table: np.ndarray, low: list[np.ndarray | int], high: dict[int, np.ndarray | int]) -> np.ndarray:
    """Rows whose levels are at least ``low`` and, on some axes, below ``high``: sums over the corners."""
    total = 0
    for chosen in product((False, True), repeat=len(high)):
        at = list(low)
        for axis, yes in zip(high, chosen, strict=True):
            at[axis] = np.maximum(low[axis], high[axis]) if yes else low[axis]
        total = total + (-1) ** sum(chosen) * table[tuple(at)]
    return total


def judged_right(table: np.ndarray, cuts: list[list[float]], values: dict[str, np.ndarray]) -> np.ndarray:
    """How many rows each combination judges right; ``values``: its thresholds."""
    passes = lambda axis, v: 1 + np.searchsorted(cuts[axis], v)
    fail = [passes(0, values["pct80_failed"]), passes(1, values["conf_failed"]), passes(2, values["bbox_failed"])]
    good = [np.maximum(a, b) for a, b in zip(fail, [passes(0, values["pct80_good"]), passes(1, values["conf_good"]), passes(2, values["bbox_good"])], strict=True)]
    wide, uneven = passes(3, values["conf_iqr_max"]), passes(4, values["line_var_max"])
    low_pct80, low_conf, good_iqr = passes(0, LOW_PCT80), passes(1, LOW_CONF), passes(3, GOOD_IQR)

    def kept(label: int) -> np.ndarray:  # not failed
        t = table[label]
        return _box(t, [*fail, 0, 0], {}) - _box(t, [*fail, wide, 0], {0: low_pct80})

    def fine(label: int) -> np.ndarray:  # good: neither failed nor, by its uneven lines, medium
        t = table[label]
        every = _box(t, [*good, 0, 0], {3: good_iqr})
        failed = _box(t, [*good, wide, 0], {0: low_pct80, 3: good_iqr})
        medium = _box(t, [*good, 0, uneven], {1: low_conf, 3: good_iqr})
        return every - failed - medium + _box(t, [*good, wide, uneven], {0: low_pct80, 1: low_conf, 3: good_iqr})

    return (table[0][0, 0, 0, 0, 0] - kept(0)) + (kept(1) - fine(1)) + fine(2)


def search(rows: DataFrame, label: str = "label", grid: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """seq, parameters, n, n_correct and accuracy of every combination; seq is its order in nested loops.

    Rows are read once and counted by level. Rows without a label, or with another than the three, count in n and are never
    right; a null measure passes no threshold. Of no rows n is 0 and the accuracy null.
    """
    grid = grid or GRID
    spark, names = rows.sparkSession, list(grid)
    sizes = [len(grid[g]) for g in names]
    table, n = passing(rows, label, grid)
    shared, cuts = spark.sparkContext.broadcast(table), _cuts(grid)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seq = batch["id"].to_numpy()
            digits = np.unravel_index(seq, sizes)
            values = {g: np.array(grid[g], float)[d] for g, d in zip(names, digits, strict=True)}
            yield pd.DataFrame({"seq": seq.astype(np.int32), **values, "n": n, "n_correct": judged_right(shared.value, cuts, values)})

    tried = spark.range(int(np.prod(sizes))).mapInPandas(run, "seq int, " + ", ".join(f"{g} double" for g in names) + ", n long, n_correct long")
    return tried.withColumn("accuracy", F.round(F.col("n_correct") / F.when(F.col("n") > 0, F.col("n")), 9))
