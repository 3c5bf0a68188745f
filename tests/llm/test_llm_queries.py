"""The queries over a small table, their oracles, and the pipeline against its stages' own decisions."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quireline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    q = con.execute(queries.ORACLES[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(q.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= before.count()
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert docs.select("doc_id").distinct().count() < n and docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_stages_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_stages_keep_odd_rows(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (None, "lone row of plain words", None, None, None)], schema)
    more = docs.withColumn("quality_score", F.lit(5.0)).withColumn("_n_lines", F.lit("x")).withColumn("_n_dropped", F.lit("y")).withColumn("rows", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:4]:
        rows = stage(spark, more, sf).collect()
        assert all((r.quality_score, r._n_lines, r._n_dropped, r.rows) == (5.0, "x", "y", 1) for r in rows) and len(rows) == stage(spark, docs, sf).count(), name
    assert corpus_pipeline.packed(spark, more, sf).count() == 4


def test_leaks_are_found_by_row(spark, sf):
    leak = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    docs = spark.createDataFrame([(None, leak), (5, leak), (5, "clean words"), (7, "clean words"), (None, "clean")], "doc_id long, text string")
    got = corpus_pipeline.unleaked(spark, docs, sf).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in docs.collect() if r.text != leak)


def test_some_odd_rows_of_the_middle_stages(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (None, "lone row of plain words", None, None, None)], schema)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert sorted(str(r.doc_id) for r in stage(spark, docs, sf).collect()) == ["1", "2", "3", "None"], name
