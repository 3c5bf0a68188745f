"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

A text is normalised byte by byte (A-Z to lower case, every other ASCII byte outside 0-9 and a-z to a space), so its
words stand between single spaces, and so do those of the windows in the automaton: a match is always whole words.
The text is scanned once; only texts with a match have their words mapped back to code points of the original.

The windows are a table, dealt into blocks that bound an automaton. A benchmark of one block, the usual case, is one scan;
of a larger one the blocks are scanned for in one job after another, so a worker never holds more than one automaton, and
the driver no more than one block.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm.common import durable

#: Consecutive words of an item that make a window; an item of fewer, but not none, is one window.
WINDOW = 10
#: Bytes of windows in one automaton, which has a node of about 40 bytes for each at most.
AUTOMATON_BYTES = 4 << 20

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BUILT: dict[str, object] = {}

FOUND = "doc_id long, n_words long, word_spans array<int>, item_ids array<string>, spans array<struct<start:int,end:int>>"


def words(text: str | bytes | None) -> list[bytes]:
    """
    >>> words("It's  A-1 Ñu")
    [b'it', b's', b'a', b'1', b'\\xc3\\x91u']
    """
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_NORMAL).split()


def windows(text: str | None, size: int = WINDOW) -> dict[bytes, int]:
    """Each window of an item, between spaces -> its words."""
    w = words(text)
    own = [w[i : i + size] for i in range(max(1, len(w) - size + 1) if w else 0)]
    return {b" %s " % b" ".join(x): len(x) for x in own}


def window_table(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, words, ids): each window of the benchmark once, with the ids of the items that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, n, i) for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for w, n in windows(text, size).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.binary(), pa.int32(), pa.string()))], ["window", "words", "item_id"])

    each = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "window binary, words int, item_id string")
    return each.groupBy("window", "words").agg(F.collect_set("item_id").alias("ids"))


Block = dict[bytes, tuple[int, list[str]]]


def _blocks(benchmark: DataFrame, size: int) -> list[DataFrame]:
    """The windows in tables of about ``AUTOMATON_BYTES`` each."""
    table = durable(window_table(benchmark, size))
    n = table.agg(F.sum(F.length("window") + F.aggregate("ids", F.lit(0), lambda a, i: a + F.length(i)))).first()[0] or 0
    k = max(1, -(-n // AUTOMATON_BYTES))
    return [table.where(F.pmod(F.xxhash64("window"), F.lit(k)) == j) if k > 1 else table for j in range(k)]


def _collected(block: DataFrame) -> Block:
    """One block, of bounded size, on the driver."""
    return {bytes(r["window"]): (r["words"], sorted(r["ids"])) for r in block.toLocalIterator()}


def _automaton(key: str, block: Block):
    import ahocorasick

    if key not in _BUILT:
        built = ahocorasick.Automaton()
        for window, (n, ids) in block.items():
            built.add_word(window.decode("latin-1"), (len(window), n, ids))
        built.make_automaton()
        _BUILT.clear()
        _BUILT[key] = built
    return _BUILT[key]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _matches(automaton, text: bytes | None) -> tuple[int, list[int], list[str]]:
    """(words of the text, begin, end, ... of those hit, ids of the items that hit them)."""
    w = words(text)
    if not w or not automaton:
        return len(w), [], []
    line = (b" %s " % b" ".join(w)).decode("latin-1")
    found = list(automaton.iter(line))
    if not found:
        return len(w), [], []
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    at = np.searchsorted(spaces, [end - size + 1 for end, (size, _, _) in found]).tolist()
    own = _merged([(i, i + n) for i, (_, (_, n, _)) in zip(at, found, strict=True)])
    return len(w), [x for s in own for x in s], sorted({i for _, (_, _, ids) in found for i in ids})


def _scan(rows: DataFrame, block: Block) -> DataFrame:
    """(doc_id, text, row) -> row, text, and what this block finds."""
    shared, key = rows.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared.value) if shared.value else None
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                texts = batch.column(1).to_pylist()
                found = [_matches(automaton, t) for t in texts]
                columns = [batch.column(0), batch.column(2), pa.array([n for n, _, _ in found], pa.int64()), pa.array([s for _, s, _ in found], pa.list_(pa.int32())), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([original(t, s) for t, (_, s, _) in zip(texts, found, strict=True)], kind)], ["doc_id", "row", "n_words", "word_spans", "item_ids", "spans"])

    return rows.mapInArrow(run, f"doc_id long, row long, {FOUND.partition(', ')[2]}")


def _union(spans: Iterable[list[int]], items: Iterable[list[str]]) -> tuple[list[int], list[str]]:
    own = _merged([x for s in spans for x in zip(s[::2], s[1::2], strict=True)])
    return [x for s in own for x in s], sorted({i for ids in items for i in ids})


def original(text: bytes | None, spans: list[int]) -> list[dict[str, int]]:
    """Spans of words as spans of code points of the text as it was, end exclusive."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text.decode())]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(spans[::2], spans[1::2], strict=True)]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Where texts hold windows of benchmark items.

    A row for each row of ``docs``: ``doc_id``, ``n_words``, ``word_spans`` (begin, end, begin, ... of words hit),
    ``item_ids`` (those with a window here, sorted) and ``spans`` (code points of the original). Reads ``doc_id`` and
    ``text`` of one side, ``item_id`` and ``text`` of the other, whatever other columns there are. Null and empty
    texts have no words; items without words match nothing; the windows of an item without an id hit words, but no id
    is listed; rows that repeat are answered each, items that repeat count once; with an empty benchmark no text is hit.
    """
    blocks = _blocks(benchmark, window)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    names = ["doc_id", "n_words", "word_spans", "item_ids", "spans"]
    if len(blocks) == 1:
        return _scan(rows.withColumn("row", F.lit(0).cast("long")), _collected(blocks[0])).select(*names)
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    hits = None
    for block in blocks:
        own = durable(_scan(rows, _collected(block)).where("size(word_spans) > 0").select("row", "word_spans", "item_ids"))
        hits = own if hits is None else hits.unionByName(own)
    hits = hits.groupBy("row").agg(F.collect_list("word_spans").alias("spans"), F.collect_list("item_ids").alias("items"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [_union(s or [], i or []) for s, i in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            columns = [batch.column(0), pa.array([len(words(t)) for t in texts], pa.int64()), pa.array([s for s, _ in found], pa.list_(pa.int32())), pa.array([i for _, i in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([original(t, s) for t, (s, _) in zip(texts, found, strict=True)], kind)], names)

    return rows.join(hits, "row", "left").select("doc_id", "text", "spans", "items").mapInArrow(merge, FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts hold no window of a benchmark item; each row is judged by itself."""
    at, blocks = docs.columns.index("text"), _blocks(benchmark, window)
    for k, block in enumerate(blocks):
        shared, key = docs.sparkSession.sparkContext.broadcast(_collected(block)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(key, shared.value) if shared.value else None
            for whole in batches:
                for begin in range(0, whole.num_rows, 512):
                    batch = whole.slice(begin, 512)
                    yield batch.filter(pa.array([not _matches(automaton, None if t is None else t.encode())[1] for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if k < len(blocks) - 1:
            docs = durable(docs)
    return docs


def digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of ``find``'s rows."""
    n_hit = F.aggregate(F.expr("transform(sequence(1, size(word_spans) div 2), i -> word_spans[2*i-1] - word_spans[2*i-2])"), F.lit(0), lambda a, x: a + x)
    n_hit = F.when(F.size("word_spans") > 0, n_hit).otherwise(0).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
