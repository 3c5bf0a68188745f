"""A corpus pipeline of training data: each stage is one operator over all that the stage before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.llm import decontamination, linededup, neardup, packing, quality
from quireline.llm.common import shared_folder, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on this input's labels, doesn't reject; null texts are as empty ones."""
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that earlier ones have, the same or one word apart; one that loses all its lines goes.

    ``n_chars`` is counted anew.
    """
    own = linededup.cleaned(docs, counts=("_quireline_n_lines", "_quireline_n_dropped")).where("_quireline_n_dropped = 0 or trim(text) <> ''")
    return own.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similar from 0.8 on; rows without words stay."""
    return neardup.dedup(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; rows are judged one by one, whatever their ids."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in packed sequences; a null text is its closing id alone."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", distinct_lines),
    ("MinHash near-dedup", distinct_documents),
    ("benchmark decontamination", unleaked),
    ("best-fit packing", packed),
]

#: No stage but the second and fourth can be said in SQL; the others are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the shared folder and read again, and the one before it deleted."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            files.delete(path(f"{folder}/{k - 1}"), True)
    return docs
