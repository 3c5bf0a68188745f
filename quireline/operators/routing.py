"""Where documents go: by category, brightness, lines or failure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.config import CATEGORIES


def by_category(records: DataFrame, keep_failed: bool = True) -> DataFrame:
    """``target`` of each record: its category, or trash for anything else; failed ones may be dropped."""
    out = records.withColumn("target", F.when(F.col("category").isin(*CATEGORIES), F.col("category")).otherwise("trash"))
    return out if keep_failed else out.where("target <> 'failed'")


def by_brightness(records: DataFrame) -> DataFrame:
    """Failures go with the normal ones."""
    return records.withColumn("target", F.when(F.col("is_dark") & F.col("error").isNull(), "dark_documents").otherwise("normal_brightness"))


def split_results(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dark, normal, failed) of brightness records."""
    ok = F.col("error").isNull()
    return records.where(F.col("is_dark") & ok), records.where(~F.col("is_dark") & ok), records.where(~ok)


def line_gate(pages: DataFrame, doc: str = "path") -> DataFrame:
    """has_line of each document, if any page has one or its detector failed, with counts of pages."""
    has = F.coalesce(F.col("has_line"), F.lit(True))
    return pages.groupBy(doc).agg(F.bool_or(has).alias("has_line"), F.count_if(has).alias("pages_with_lines"), F.count("*").alias("total_pages"))


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(those that went well, those with an error)."""
    return rows.where("error is null"), rows.where("error is not null")


def without_output(inputs: DataFrame, outputs: DataFrame, key: str = "path") -> DataFrame:
    return inputs.join(outputs.select(key), key, "left_anti")


def mode_of(column: str = "mode"):
    """The enhancement that a mode names; an unknown one is an error."""
    known = ("ocrmypdf", "scantailor_then_ocr", "unpaper_tesseract")
    c = F.col(column)
    return F.when(c.isin(*known), c).otherwise(F.raise_error(F.concat(F.lit("unknown mode "), c)))
