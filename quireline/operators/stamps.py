"""Stamps found on pages: counts over a detector's boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONF = 0.8


def num_stamps(boxes: Column, conf_threshold: float = CONF) -> Column:
    return F.size(F.filter(F.coalesce(boxes, F.array()), lambda b: b["conf"] >= conf_threshold))


def folder_summary(images: DataFrame, conf_threshold: float = CONF) -> DataFrame:
    """One row: images and stamps over (path, stamps)."""
    return images.agg(F.count("*").alias("total_images"), F.coalesce(F.sum(num_stamps(F.col("stamps"), conf_threshold)), F.lit(0).cast("long")).alias("total_stamps"))


def removal_summary(cleaned: DataFrame) -> DataFrame:
    """One row: images, stamps taken out and images that couldn't be cleaned, over (num_stamps, error)."""
    ok = F.col("error").isNull()
    return cleaned.agg(F.count("*").alias("total_images"), F.coalesce(F.sum(F.when(ok, F.col("num_stamps"))), F.lit(0)).cast("long").alias("total_stamps"), F.count_if(~ok).alias("failed"))
