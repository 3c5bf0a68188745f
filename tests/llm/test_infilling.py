"""Fill-in-the-middle against a plain version that cuts lists of units."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quireline.llm import infilling


def plainly(doc_id, text):
    t = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(u), "plain", None, None, t
    if h[3] % 100 < 20:
        return doc_id, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    units = ["a", "Word", " ", "\n", "\r\n", "é", "語", "𝔘𝔫", "<", "<S", ">", "P>", "9", " ", "\x00", "z" * 90]
    yield from ((1, None), (2, ""), (3, "x"), (4, " "), (5, "has <M> in it"), (6, "<P>"), (7, "q" * 5000), (8, "q " * 32), (9, "é" * 64), (10, "é" * 65), (11, "ab " * 20000), (None, "no id"), (None, "another without id"), (None, None))
    for i in range(12, 260):
        yield i, "".join(rng.choices(units, k=rng.choice((1, 2, 3, 20, 63, 64, 65, 127, 128, 129, 400))))


def test_same_as_lists_of_units(spark):
    rows = list(texts()) + [(20, "one id"), (20, "two texts"), (21, "twice the same row"), (21, "twice the same row")] + [(22, "many copies of one row")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = infilling.infilled(df).withColumn("again", infilling.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter(plainly(*r) for r in rows)
    assert all(r.again == r.text for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}


def test_marks_around_a_cut_are_not_taken_for_marks(spark):
    rows = [(i, "<S<P<M" * k + ">") for i in range(40) for k in (1, 3)]
    got = infilling.infilled(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("again", infilling.restored(F.col("output"), F.col("form"))).collect()
    assert all(r.again == r.text for r in got) and len(got) == 80


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "some words here", 3, "x", 4)], "doc_id long, text string, n int, form string, _k1 int")
    assert [tuple(r)[:2] for r in infilling.infilled(df).collect()] == [(1, 5)]
    assert infilling.digest(infilling.infilled(df.limit(0))).count() == 0


def test_whole_texts_are_shuffled_once(spark, sf):
    """Texts are many, so that neither side of a join is broadcast; all branches then read one exchange."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = infilling.infilled(spark.read.parquet(f"{sf}/documents.parquet"))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    exchanges = [line for line in plan.splitlines() if re.search(r"[+:]- Exchange hashpartitioning", line)]
    assert len(exchanges) == 1 and plan.count("ReusedExchange") == 2, plan


@pytest.mark.parametrize("text", ["", "a", "a b", "é", "ab cd ef"])
def test_restored_of_plain_outputs(spark, text):
    df = spark.createDataFrame([(text, "plain")], "output string, form string")
    assert df.select(infilling.restored(F.col("output"), F.col("form"))).first()[0] == text
