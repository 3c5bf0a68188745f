"""Tables and files that results go to."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from quireline.sources.filesink import named_files
from quireline.tables import opened


def routed(records: DataFrame, folder: str, targets: tuple[str, ...], column: str = "target") -> dict[str, int]:
    """Writes records dealt by target, each to its own part of a new version of the table; how many went to each target.

    The records are evaluated once: targets are counted by the job that writes them. The version counts when its manifest stands,
    which names it and all its counts, so readers see every target's rows or none, and an earlier version until then. A target
    that isn't listed, or null, is an error before anything is seen. Nothing is shuffled: each task writes its rows of every target.
    """
    version, seen = uuid.uuid4().hex, Observation(f"routed-{uuid.uuid4().hex}")
    known = F.col(column).isin(*targets)
    checked = records.withColumn(column, F.when(known, F.col(column)).otherwise(F.raise_error(F.concat(F.lit("no such target: "), F.coalesce(F.col(column), F.lit("null"))))))
    counted = checked.observe(seen, *(F.count_if(F.col(column) == t).alias(f"n{k}") for k, t in enumerate(targets)))
    counted.write.partitionBy(column).parquet(f"{folder}/version-{version}")
    counts = {t: seen.get[f"n{k}"] for k, t in enumerate(targets)}
    _publish(folder, {"version": version, "column": column, "schema": records.schema.json(), "counts": counts})
    return counts


def _publish(folder: str, said: dict) -> None:
    """The manifest, in one move over the one before it."""
    fs, at = opened(folder)
    aside = f"{at}/_manifest-{said['version']}"
    with fs.open_output_stream(aside) as f:
        f.write(json.dumps(said).encode())
    fs.move(aside, f"{at}/_manifest")


def manifest(folder: str) -> dict:
    fs, at = opened(folder)
    with fs.open_input_stream(f"{at}/_manifest") as f:
        return json.loads(f.read())


def target(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows that went to a target, without its column; other targets' files aren't read."""
    from pyspark.sql.types import StructType

    said = manifest(folder)
    schema = StructType.fromJson(json.loads(said["schema"]))
    return spark.read.schema(schema).parquet(f"{folder}/version-{said['version']}").where(F.col(said["column"]) == name).drop(said["column"])


def quarantined(rows: DataFrame, folder: str) -> dict[str, int]:
    """Rows without an error and rows with one as two targets, ``good`` and ``bad``, of one table; how many there are of each."""
    return routed(rows.withColumn("target", F.when(F.col("error").isNull(), "good").otherwise("bad")), folder, ("good", "bad"))


def csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def log(rows: DataFrame, path: str) -> None:
    """Added to what is there."""
    rows.write.mode("append").parquet(path)


def text_files(rows: DataFrame, folder: str, suffix: str = "") -> None:
    """One file of text for each (stem, text) in one folder, named by the stem, the suffix and ``.txt``; of rows that share a stem the texts in order."""
    own = rows.select(F.concat("stem", F.lit(f"{suffix}.txt")).alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    named_files(own, folder, "content", overwrite=True)


def page_files(pages: DataFrame, folder: str) -> None:
    """Each page of documents (path, page_no and its image) as a PDF of its own, ``{stem}_page_{n}.pdf``."""
    from quireline.functions.text import basename, page_name

    named_files(pages.where("error is null").withColumn("name", page_name(basename(F.col("path")), F.col("page_no"))), folder, kind="pdf")


def document_files(pages: DataFrame, folder: str) -> None:
    """The pages of each document (path, page_no and its image) as one PDF of its name."""
    from quireline.functions.text import basename

    named_files(pages.where("error is null").withColumn("name", basename(F.col("path"))), folder, "page_no", kind="pdf")


def png(height: int, width: int, channels: int, data: bytes) -> bytes:
    """A PNG of a gray (1), BGR (3) or BGRA (4) image."""
    import numpy as np

    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    a = a if channels == 1 else a[..., [2, 1, 0, 3][:channels]]
    rows = np.concatenate([np.zeros((height, 1), np.uint8), a.reshape(height, -1)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def image_files(pages: DataFrame, folder: str, suffix: str = "_clean") -> None:
    """The image of each page (path, image) that has no error, as ``{stem}{suffix}.png``; of a path's several pages a name each by their number."""
    from quireline.functions.text import stem

    @F.pandas_udf(BinaryType())
    def encoded(image):
        return image.apply(lambda r: None if r["data"] is None else png(r["height"], r["width"], r["nChannels"], bytes(r["data"])), axis=1)

    number = F.when(F.coalesce("page_no", F.lit(1)) > 1, F.concat(F.lit("_"), F.col("page_no").cast("string"))).otherwise("")
    own = pages.where("error is null and image is not null")
    named_files(own.select(F.concat(stem(F.col("path")), number, F.lit(f"{suffix}.png")).alias("name"), encoded("image").alias("content")), folder)


def observed(rows: DataFrame, done: Callable[[dict], None], **metrics: Column) -> tuple[DataFrame, Callable[[], None]]:
    """(rows that count metrics as they pass, a call that hands the metrics to ``done`` once the rows were written)."""
    seen = Observation(f"observed-{uuid.uuid4().hex}")
    return rows.observe(seen, *(c.alias(name) for name, c in metrics.items())), lambda: done(dict(seen.get))
