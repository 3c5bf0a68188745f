"""Edit distance by bits against the table of numbers."""

import random
import time

import pytest
from pyspark.sql import functions as F

from quireline.functions import edits
from quireline.functions.text import cer


def plainly(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def changed(rng, text, n, letters):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out) + 1)
        kind = rng.random()
        if kind < 0.4:
            out.insert(at, rng.choice(letters))
        elif out and kind < 0.7:
            del out[min(at, len(out) - 1)]
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("band", [1, 2, 3, 8, 64])
def test_every_band(monkeypatch, band):
    monkeypatch.setattr(edits, "BAND", band)
    rng = random.Random(band)
    for _ in range(400):
        letters = rng.choice(["ab", "abcdé語😀", "abcdefghijklmnopqrstuvwxyz "])
        a = "".join(rng.choices(letters, k=rng.choice((0, 1, 2, 5, 17, 40, 90))))
        b = changed(rng, a, rng.choice((0, 1, 2, 5, 20)), letters) if rng.random() < 0.7 else "".join(rng.choices(letters, k=rng.randrange(60)))
        assert edits.distance(a, b) == edits.distance(b, a) == plainly(a, b), (a, b)


def test_single_bands():
    rng = random.Random(0)
    for _ in range(600):
        a = "".join(rng.choices("abc", k=rng.randrange(12, 60)))
        b = changed(rng, a, rng.randrange(9), "abc")
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        d, k = plainly(a, b), rng.randrange(1, 12)
        if b and 2 * k + 1 < len(a):  # wider bands aren't used
            assert edits._banded(a, b, k) == (d if d <= k else None) and edits._whole(a, b) == d, (a, b, k)


def test_long_texts_take_seconds():
    rng = random.Random(7)
    a = "".join(rng.choices("abcdefghij klmn", k=100_000))
    b = changed(rng, a, 3_000, "abc")
    began = time.monotonic()
    d = edits.distance(a, b)
    assert 2_000 < d <= 3_000 and edits.distance(a[::-1], b[::-1]) == d
    other = "".join(rng.choices("abcdefghij klmn", k=100_000))
    assert edits.distance(a, other) > 50_000
    assert time.monotonic() - began < 60


def test_column(spark, monkeypatch):
    monkeypatch.setattr(edits, "CELLS", 30)
    rows = [("kitten", "sitting"), ("", "abc"), ("abc", ""), (None, "abc"), ("abc", None), ("grün 😀 語", "grun 語"), ("x" * 500, "x" * 499 + "y"), ("a" * 9, "b" * 900)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(2)
    got = {(r.a, r.b): r.d for r in df.select("a", "b", edits.edits(F.col("a"), F.col("b")).alias("d")).collect()}
    assert got == {(a, b): None if a is None or b is None else plainly(a, b) for a, b in rows}
    rates = {(r.a, r.b): r.c for r in df.select("a", "b", cer(F.col("a"), F.col("b")).alias("c")).collect()}
    assert rates == {(a, b): round(plainly(a or "", b) / len(b), 6) if b else 0.0 for a, b in rows}
