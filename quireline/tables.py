"""Tables that are written once and read again: lineage is cut by Parquet in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows that a task sorts or groups, about.
TOGETHER = 200_000


def tasks(*rows: DataFrame) -> int:
    """Tasks over which the largest of these tables is dealt, by its count: with more rows there are more tasks, not larger ones.

    Of a table of Parquet files the count is read from their footers. A number of its own is needed, as one that the session names
    is merged by bytes on disk, which columns of few values make small.
    """
    return max(rows[0].sparkSession.sparkContext.defaultParallelism, *(-(-r.count() // TOGETHER) for r in rows))


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it names none a local session (tests, a laptop) gets a temporary one; on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = sc.getConf().get("spark.checkpoint.dir")
        if not given and sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="quireline-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, *by: str) -> DataFrame:
    """The same rows, read from a table in the shared folder; ``by``: columns that make its folders, so that readers of some skip the others."""
    place = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def opened(folder: str):
    """(pyarrow's filesystem, the path in it) of a place that Spark names by an address or, on one machine, by a path."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if folder.startswith(("/", "file:/")):
        return LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(folder)
