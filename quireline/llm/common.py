"""What the operators of this subpackage share: durable intermediate tables and table access.

Executors can be lost at any time, so anything that is read more than once or that closes a loop
is written as a Parquet table into the folder that ``spark.checkpoint.dir`` names, and read from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.tables import opened, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame, level: int = 3) -> DataFrame:
    """The same rows, written to a table in the shared folder and cut from their lineage; readers skip the columns they don't need.

    ``level`` is how hard it is compressed; a table of whole texts is worth more than the default.
    """
    place = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


#: Items (rows of a few fixed-width columns, or entries of their arrays) that may be broadcast; beyond so many a join is shuffled.
BROADCAST_ITEMS = 100_000


def small(df: DataFrame, items=None) -> DataFrame:
    """A durable table, marked for broadcast where its items, counted, are few; ``items``: how many a row has, where not one."""
    df = durable(df)
    n = df.agg(F.count("*") if items is None else F.sum(items.cast("long"))).first()[0] or 0
    return F.broadcast(df) if n <= BROADCAST_ITEMS else df


def held_out(doc_id):
    """Rows never learned from: crc32 of the id as text leaves no rest by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


__all__ = ["BROADCAST_ITEMS", "durable", "held_out", "opened", "shared_folder", "small", "table"]
