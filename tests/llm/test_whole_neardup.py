"""Near-dedup drops rows of a component alone, whatever their ids."""

import random

from quireline.llm import neardup


def text(seed, n=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))


def test_rows_that_share_an_id_or_have_none(spark):
    near = text(7) + " end"
    rows = [(None, text(1)), (None, text(2)), (None, text(2)), (None, text(7)), (None, near), (5, text(3)), (5, text(4)), (3, text(4)), (5, text(3)), (None, None), (None, ""), (8, text(1))]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, rows long")
    out = neardup.dedup(docs)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == docs.columns
    assert sum(t in (text(7), near) for _, t in got) == 1
    rest = [x for x in got if x[1] not in (text(7), near)]
    assert sorted(rest, key=str) == sorted([(None, text(2)), (5, text(3)), (3, text(4)), (None, None), (None, ""), (8, text(1))], key=str)
