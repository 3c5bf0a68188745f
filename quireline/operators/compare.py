"""Recognised text against reference text: joins and character error rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.functions.text import cer, stem


def cer_by_file(hyp: DataFrame, ref: DataFrame, half_even: bool = True) -> DataFrame:
    """filename, hyp_len, ref_len, cer of the files (filename, text) that both sides have."""
    pairs = hyp.select("filename", F.col("text").alias("hyp")).join(ref.select("filename", F.col("text").alias("ref")), "filename")
    return pairs.select("filename", F.length("hyp").alias("hyp_len"), F.length("ref").alias("ref_len"), cer(F.col("hyp"), F.col("ref"), half_even).alias("cer"))


def corpus_cer(rows: DataFrame, half_even: bool = True) -> DataFrame:
    """One row: the files' rates weighed by the length of their references; 0 without any."""
    total = F.sum("ref_len")
    share = F.sum(F.col("cer") * F.col("ref_len")) / total
    return rows.agg(F.coalesce(F.when(total > 0, (F.bround if half_even else F.round)(share, 6)), F.lit(0.0)).alias("cer"), F.count("*").alias("files"))


def with_reference(runs: DataFrame, refs: DataFrame) -> DataFrame:
    """Runs (filename, text) with the text of ``{stem}.txt`` or else ``{stem}.ref.txt`` among refs (filename, text), if there is one."""
    name = F.lower("filename")
    plain, marked = name.endswith(".txt") & ~name.endswith(".ref.txt"), name.endswith(".ref.txt")
    ranked = refs.where(plain | marked).select(F.when(marked, F.regexp_replace("filename", r"(?i)\.ref\.txt$", "")).otherwise(F.regexp_replace("filename", r"(?i)\.txt$", "")).alias("stem"), marked.cast("int").alias("rank"), "text")
    first = ranked.groupBy("stem").agg(F.min_by("text", "rank").alias("ref"))
    return runs.withColumn("stem", stem(F.col("filename"))).join(first, "stem", "left")


def compare_backends(texts: DataFrame, refs: DataFrame, backends: list[str]) -> DataFrame:
    """filename and, for each backend, length and character error rate; texts are (filename, backend, text)."""
    own = texts.join(refs.select("filename", F.col("text").alias("ref")), "filename", "left")
    rated = own.select("filename", "backend", F.length("text").alias("len"), F.when(F.col("ref").isNotNull(), cer(F.col("text"), F.col("ref"), half_even=False)).alias("cer"))
    return rated.groupBy("filename").pivot("backend", backends).agg(F.first("len").alias("len"), F.first("cer").alias("cer"))


def sweep(texts: DataFrame, refs: DataFrame, *params: str) -> DataFrame:
    """Corpus rate of each combination of parameters; texts are (params, filename, text)."""
    own = texts.join(refs.select("filename", F.col("text").alias("ref")), "filename").select(*params, F.length("ref").alias("n"), cer(F.col("text"), F.col("ref"), half_even=False).alias("cer"))
    return own.groupBy(*params).agg(F.count("*").alias("files"), F.round(F.sum(F.col("cer") * F.col("n")) / F.sum("n"), 6).alias("cer"))
