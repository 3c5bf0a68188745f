"""Folders of documents, images and texts as DataFrames. Empty folders give empty frames, missing ones an error at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.functions.text import basename, is_image, is_ocr_input
from quireline.schemas import TRAINING


def binary(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """path, name, content, length of the files whose name fits; names are compared as the glob says."""
    own = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return own.select("path", basename(F.col("path")).alias("name"), "content", "length")


def pdfs(spark: SparkSession, folder: str, any_case: bool = True) -> DataFrame:
    return binary(spark, folder, "*.[pP][dD][fF]" if any_case else "*.pdf")


def listing(files: DataFrame) -> DataFrame:
    return files.orderBy("name")


def ocr_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return binary(spark, folder).where(is_ocr_input(F.col("path")))


def image_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    return binary(spark, folder, recursive=recursive).where(is_image(F.col("path")))


def rasters(spark: SparkSession, folder: str) -> DataFrame:
    """path, page_no, image (BGR), error; a file that can't be decoded is a row with an error."""
    own = spark.read.format("image").option("dropInvalid", "false").load(folder).select("image.*")
    bad = F.col("height") < 0
    image = F.when(~bad, F.struct("height", "width", "nChannels", "mode", "data"))
    return own.select(F.col("origin").alias("path"), F.lit(1).alias("page_no"), image.alias("image"), F.when(bad, "ValueError: not an image").alias("error"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """filename and text of .txt files; bytes that aren't UTF-8 are left out, as in a lenient reader."""

    @F.pandas_udf("string")
    def decoded(content):  # the JVM's decoder puts a replacement character in their place
        return content.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return binary(spark, folder, "*.[tT][xX][tT]").select(F.col("name").alias("filename"), decoded("content").alias("text"))


def labelled(spark: SparkSession, folder: str, labels: tuple[str, ...] = ("failed", "medium", "good")) -> DataFrame:
    """PDFs below folders that are named by their label, as path, name, content, label; folders that aren't there are passed over."""
    own = binary(spark, folder, "*.[pP][dD][fF]", recursive=True).withColumn("label", F.element_at(F.split("path", "/"), -2))
    return own.where(F.col("label").isin(*labels)).select("path", "name", "content", "label")


def training_csv(spark: SparkSession, path: str) -> DataFrame:
    return checked(spark.read.schema(TRAINING).csv(path, header=True))


# What a training table must have.
REQUIRED = ("true_label", "pct80", "median_ocr_conf", "mean_ocr_conf", "bbox_area_text_frac", "conf_iqr", "line_height_var", "line_spacing_var", "text_blocks_count")


def checked(rows: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    if missing := [c for c in required if c not in rows.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return rows
