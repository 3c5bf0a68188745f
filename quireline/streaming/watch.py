"""A folder that fills over time, through the same operators: each file once, by the query's own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quireline.functions.text import basename

FILE = "path string, modificationTime timestamp, length long, content binary"


def files(spark: SparkSession, folder: str, glob: str = "*.[pP][dD][fF]", at_once: int = 1000) -> DataFrame:
    """path, name, content of files as they come."""
    own = spark.readStream.schema(FILE).format("binaryFile").option("pathGlobFilter", glob).option("maxFilesPerTrigger", at_once).load(folder)
    return own.select("path", basename(F.col("path")).alias("name"), "content", "modificationTime")


def through(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Runs each batch through a stage and writes it under the batch's number, so that one that is tried again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    out = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()


def failures_by_hour(runs: DataFrame, late: str = "1 hour") -> DataFrame:
    """Runs and failures of each hour of ``ts``; rows later than ``late`` are too late."""
    return runs.withWatermark("ts", late).groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("processed"), F.count_if(F.col("status") != "ok").alias("failed"))
