"""Best-fit packing of token sequences (best-two-fit), planned on a histogram of lengths.

What fits where depends on lengths alone, and there are at most ``capacity`` of them. So the driver
sees one row a length, never a document: it fills bins greedily over the counts, swaps a bin's
smallest document for the two unpacked ones that fit its expanded gap more tightly, and repeats each
bin as often as the counts allow. Executors then rank the pieces of each length and look their place
up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireline.llm.common import durable
from quireline.llm.tokenizing import encoder, public_vocabulary

#: Tokens of a packed sequence.
CAPACITY = 2048
#: Id that closes each document.
END_ID = 0
#: Pieces of one length that one task ranks, about.
RANKED_TOGETHER = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only longer runs are cut, and the first piece takes the rest.

    >>> cut(3, 4), cut(10, 4)
    ([(0, 3)], [(0, 2), (2, 4), (6, 4)])
    """
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))] if n else []


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of the ids of every whole text, each text closed by ``END_ID``.

    Reads ``doc_id`` and ``text`` alone, whatever other columns there are. A null or empty text is the closing
    id alone; rows that repeat are cut like any other row; an empty table has no pieces. ``with_ids`` adds the ids.
    """
    ranks, pattern = vocabulary or public_vocabulary()
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(ranks, pattern).packed
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows: list[tuple] = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = packed(text) + end
                    for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, k, start, length, zlib.crc32(own), *([np.frombuffer(own, "<u4").astype("i4")] if with_ids else [])))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                columns = list(zip(*rows, strict=True)) if rows else [()] * (5 + with_ids)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=False)], names[: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths in order, how many such bins) that use up the counts of lengths.

    Of equal choices the one with the longest document is taken. A bin of a single document keeps it.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a length of {length} doesn't fit {capacity}")
        left[length] = n
    held = np.zeros(capacity + 1, np.int64)  # by the bin that is being filled

    def largest(up_to: int) -> int:
        found = np.flatnonzero(left[: up_to + 1] > held[: up_to + 1])
        return int(found[-1]) if len(found) else 0

    plan = []
    while top := largest(capacity):
        bin_, gap = [], capacity
        while gap and (length := largest(min(gap, top))):
            bin_.append(length)
            held[length] += 1
            gap -= length
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            held[smallest] -= 1
            if two := _two(left - held, gap + smallest, smallest):
                bin_[-1:] = two
                for length in two:
                    held[length] += 1
            else:
                held[smallest] += 1
        used = np.flatnonzero(held)
        times = int((left[used] // held[used]).min())
        left[used] -= times * held[used]
        held[:] = 0
        plan.append((tuple(bin_), times))
    return plan


def _two(free: np.ndarray, room: int, more_than: int) -> list[int] | None:
    """The two lengths whose sum is largest, at most room and over more_than."""
    there = np.flatnonzero(free[: room + 1] > 0)
    there = there[there > 0]
    if not len(there):
        return None
    at = np.searchsorted(there, np.minimum(room - there, there), "right") - 1  # the second is no longer than the first
    ok = at >= 0
    first, second = there[ok], there[at[ok]]
    alone = (first == second) & (free[first] < 2)
    back = at[ok] - 1
    second = np.where(alone, np.where(back >= 0, there[np.maximum(back, 0)], -room - 1), second)
    sums = first + second
    if not len(sums) or sums.max() <= more_than:
        return None
    k = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return [int(first[k]), int(second[k])]


def _places(plan: Iterable[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length, from which rank on its pieces stand in which bins and where."""
    rows, base, seen = [], 0, {}
    for bin_, times in plan:
        offset = 0
        for length in bin_:
            rank = seen.get(length, 0)
            rows.append((length, rank, base, offset))
            seen[length] = rank + times
            offset += length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 45) + table[:, 1], "rank": table[:, 1], "base": table[:, 2], "offset": table[:, 3]}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: gapless places from 0 in sequences of at most ``capacity`` tokens.

    Needs ``doc_id``, ``piece`` and ``length``; every other column is passed on. Ranks of equal rows are arbitrary, so
    their places may be swapped, which changes no sequence's content.
    """
    pieces = durable(pieces)
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    places = spark.sparkContext.broadcast(_places(best_two_fit(counts, capacity)))  # a few rows a length, whatever the input
    salts = max(8, sum(counts.values()) // RANKED_TOGETHER)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = before.select("length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    in_salt = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece"))
    ranked = salted.withColumn("_in_salt", in_salt).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_in_salt") - 1)
    kept = pieces.columns
    ranked = ranked.select(*kept, "_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        for batch in batches:
            rank = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            length = batch.column(kept.index("length")).to_numpy(zero_copy_only=False)
            k = np.searchsorted(p["key"], (length << 45) + rank, "right") - 1
            columns = [*batch.columns[:-1], pa.array(p["base"][k] + rank - p["rank"][k], pa.int64()), pa.array(p["offset"][k], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
