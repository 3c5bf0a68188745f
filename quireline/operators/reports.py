"""Counts, accuracies and other summaries of record sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireline.config import CATEGORIES
from quireline.operators.ranks import ranked


def category_counts(records: DataFrame) -> DataFrame:
    """How many records each category has, those without any among them; other values count as trash."""
    own = F.when(F.col("category").isin(*CATEGORIES), F.col("category")).otherwise("trash")
    counts = records.groupBy(own.alias("category")).agg(F.count("*").alias("n"))
    every = records.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return every.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def dark_counts(records: DataFrame) -> DataFrame:
    ok = F.col("error").isNull()
    return records.agg(F.count_if(F.col("is_dark") & ok).alias("dark"), F.count_if(~F.col("is_dark") & ok).alias("normal"), F.count_if(~ok).alias("errors"))


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("processed"), F.count_if(F.col("status") == "ok").alias("success"), F.count_if(F.col("status") != "ok").alias("failed"))


def accuracy(rows: DataFrame, *by: str) -> DataFrame:
    """Rows, correct ones and their share, overall or by columns; 0 without rows."""
    own = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("correct").cast("long").alias("n_correct"), F.round(F.avg("correct"), 6).alias("accuracy"))
    return own if by else own.select(F.col("n"), F.coalesce("n_correct", F.lit(0).cast("long")).alias("n_correct"), F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"))


def classification_report(rows: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support of each label that occurs, then their macro and weighted means."""
    pairs = rows.groupBy(label, predicted).agg(F.count("*").alias("n"))
    sides = pairs.select(F.col(label).alias("name"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"), F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0).alias("hit"))
    sides = sides.unionByName(pairs.select(F.col(predicted).alias("name"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"), F.lit(0).cast("long").alias("hit")))
    each = sides.groupBy("name").agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    share = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    each = each.withColumn("precision", share(F.col("hit"), F.col("said"))).withColumn("recall", share(F.col("hit"), F.col("support")))
    each = each.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    metrics = ("precision", "recall", "f1")
    macro = each.agg(F.lit("macro avg").alias("name"), *(F.avg(m).alias(m) for m in metrics), F.sum("support").alias("support"))
    weighted = each.agg(F.lit("weighted avg").alias("name"), *(share(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in metrics), F.sum("support").alias("support"))
    out = each.select("name", *metrics, "support").unionByName(macro).unionByName(weighted)
    return out.select("name", *(F.round(m, 6).alias(m) for m in metrics), "support")


def numbered(rows: DataFrame, name: str = "name") -> DataFrame:
    """Rows by name with their index from 1, the total and how many are left."""
    out = ranked(rows, name, rank="_i", total="n")
    return out.select(*rows.columns, (F.col("_i") + 1).cast("int").alias("i"), "n", (F.col("n") - F.col("_i") - 1).alias("remaining"))


def folds(rows: DataFrame, label: str, key: Column, k: int = 5) -> DataFrame:
    """Stratified folds: rows of a label are dealt in turn in the order of a key, which should be a hash with an id behind it."""
    out = ranked(rows, key, by=(label,), rank="fold")
    return out.withColumn("fold", (F.col("fold") % k).cast("int"))


def weighted_median(rows: DataFrame, value: str, weight: str, *by: str) -> DataFrame:
    """Least value at which the running weight reaches half of its group's."""
    run = F.sum(weight).over(Window.partitionBy(*by).orderBy(value).rangeBetween(Window.unboundedPreceding, 0))
    own = rows.select(*by, value, run.alias("_run"), F.sum(weight).over(Window.partitionBy(*by)).alias("_all"))
    return own.where(F.col("_run") >= F.col("_all") / 2).groupBy(*by).agg(F.min(value).alias("weighted_median"))


def best_first(rows: DataFrame, score: str, seq: str) -> DataFrame:
    """The row of the best score; of equal ones the first."""
    return rows.orderBy(F.desc(score), seq).limit(1)
