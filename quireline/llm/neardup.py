"""MinHash near-dedup by a multi-index Hamming join, exact on full shingle sets.

A set of word shingles becomes a signature of b-bit MinHash symbols, cut into chunks. Two signatures that differ in at
most ``2 * chunks - 1`` symbols have, by the pigeonhole principle, a chunk that differs in one symbol at most. So each
chunk emits, for each of its symbols, a key without that symbol: every pair under that distance shares a key. The
distance bound is set so that a pair at the similarity threshold lies beyond it with a chance of ``MISS`` at most.

Equal sets are one node throughout, so copies never meet each other. What shares a key is resolved without listing
pairs: first each bucket's members against its least one, then, in buckets that still hold several components, members
against members inside bounded blocks, which report a spanning forest of their links. All links are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm.common import durable

#: Bits of a signature's symbol.
BITS = 24
#: Chance that a pair at the threshold itself is beyond the signature distance.
MISS = 5e-4
#: Shingles that a block of a bucket holds, about; a pair of blocks is one task's group.
BLOCK = 1_500_000

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_P, _Q, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass(frozen=True)
class Plan:
    """``k`` words a shingle, linked from ``percent`` / 100 on; ``chunks`` of ``symbols`` each."""

    k: int
    percent: int
    chunks: int
    symbols: int

    @property
    def distance(self) -> int:
        return 2 * self.chunks - 1


def plan(k: int = 5, percent: int = 80) -> Plan:
    """Fewest chunks that keep the chance of a miss under ``MISS``.

    >>> plan(3, 85).chunks, plan(3, 85).symbols
    (7, 5)
    """
    symbols = 5 if percent >= 85 else 4
    for chunks in range(1, 64):
        h, p = chunks * symbols, 1 - percent / 100
        if sum(comb(h, x) * p**x * (1 - p) ** (h - x) for x in range(2 * chunks, h + 1)) <= MISS:
            return Plan(k, percent, chunks, symbols)
    raise ValueError(f"no plan for a similarity of {percent} / 100")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _Q
    h = (h ^ (h >> np.uint64(27))) * _R
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the k-word shingles of each text, A-Z in lower case.

    Words are runs without the six ASCII white-space characters. A text of fewer words has its whole sequence as one
    shingle; null, empty and blank texts have none.
    """
    buffer = np.frombuffer(b"".join(b" " + (t or b"").lower() + b" " for t in texts), np.uint8)
    starts = np.cumsum([0, *(len(t or b"") + 2 for t in texts)])
    space = _SPACES[buffer]
    begin = np.flatnonzero(~space[1:] & space[:-1]) + 1
    end = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    with np.errstate(over="ignore"):
        x = (buffer.astype(np.uint64) + np.uint64(1)) * _Q
        power = np.full(len(buffer), _P)
        power[:1] = 1
        total = np.cumsum(x * np.multiply.accumulate(power), dtype=np.uint64)
        power[1:] = _INVERSE
        words = _mix((total[end - 1] - total[begin - 1]) * np.multiply.accumulate(power)[begin]) if len(begin) else np.zeros(0, np.uint64)
        first = np.searchsorted(begin, starts)
        rolling = words.copy()
        for j in range(1, k):
            rolling = rolling[: len(words) - j] * _P + words[j:] if len(words) > j else rolling[:0]
        rolling = _mix(rolling)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(rolling[a : b - k + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = h * _P + w
                out.append(_mix(np.array([h + _R])))
            else:
                out.append(words[:0])
    return out


def signatures(sets: list[np.ndarray], p: Plan) -> np.ndarray:
    """One row of ``chunks * symbols`` b-bit MinHash symbols a set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    rng = np.random.default_rng(20)
    out = np.empty((len(sets), p.chunks * p.symbols), np.uint32)
    with np.errstate(over="ignore"):
        for h in range(out.shape[1]):
            a, b = (np.uint64(v) for v in rng.integers(1, 1 << 63, 2))
            low = np.minimum.reduceat(_half((flat ^ b) * (a | np.uint64(1))), starts)
            out[:, h] = _mix(low.astype(np.uint64) + np.uint64(h)) >> np.uint64(64 - BITS)
    return out


def _half(x: np.ndarray) -> np.ndarray:
    return ((x ^ (x >> np.uint64(32))) * _Q) >> np.uint64(16)


def keys(sig: np.ndarray, p: Plan) -> np.ndarray:
    """Keys of each signature: every chunk without each of its symbols in turn."""
    cut = sig.reshape(len(sig), p.chunks, p.symbols).astype(np.uint64)
    out = np.empty((len(sig), p.chunks, p.symbols), np.uint64)
    with np.errstate(over="ignore"):
        for drop in range(p.symbols):
            h = np.full((len(sig), p.chunks), drop + 1, np.uint64) + np.arange(p.chunks, dtype=np.uint64) * np.uint64(64)
            for s in range(p.symbols):
                if s != drop:
                    h = _mix(h * _P + cut[:, :, s])
            out[:, :, drop] = h
    return out.reshape(len(sig), -1).astype(np.int64)


def _digest(own: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((_mix(own ^ _R).sum(dtype=np.uint64) * _P ^ np.uint64(len(own))).astype(np.int64))


def _row():
    """Tells rows of one id, or of none, apart by their texts."""
    return F.xxhash64(F.col("text").cast("string"))


def _sets(docs: DataFrame, p: Plan, full: bool) -> DataFrame:
    """doc_id, row (a hash of the text), n, node (a digest of the set, null for none) and the signature, or the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                size, held = 0, 0
                texts = []
                while at + size < whole.num_rows and size < 512 and held < 4_000_000:
                    texts.append(whole.column(1)[at + size].as_py())
                    held += len(texts[-1] or b"")
                    size += 1
                sets = shingle_sets(texts, p.k)
                there = [s for s in sets if len(s)]
                if full:
                    own = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                else:
                    sig = iter(signatures(there, p)) if there else iter(())
                    own = pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())
                node = pa.array([_digest(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(at, size), whole.column(2).slice(at, size), pa.array([len(s) for s in sets], pa.int64()), node, own], ["doc_id", "row", "n", "node", "own"])
                at += size

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"), _row().alias("row")).mapInArrow(run, f"doc_id long, row long, n long, node long, own {'array<long>' if full else 'binary'}")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of (a, b); the label is the least node that can be reached.

    Least labels spread along edges and along the labels themselves, so paths halve each round.
    """
    both = durable(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = durable(labels)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        grown = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("label").alias("far"))
        grown = durable(grown.join(jump, "l", "left").select("node", F.least("l", F.coalesce("far", "l")).alias("label"), (F.least("l", F.coalesce("far", "l")) < F.col("label")).alias("less")))
        labels = grown.select("node", "label")
        if not grown.where("less").limit(1).count():
            return labels


def _linked(i, size_a, size_b, percent: int):
    return 100 * i >= percent * (size_a + size_b - i)


def link(docs: DataFrame, p: Plan) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs``.

    Two rows are linked where 100 * intersection >= percent * union of their shingle sets; ``component_id`` is the least
    doc_id that links reach, and ``kept`` says that it is the row's own. Rows without shingles (null, empty or blank
    texts) are linked with nothing. Rows that repeat an id are of one component if their texts are linked and are each
    answered; ids that are null reach others but are never the least unless all are. Other columns aren't read.
    """
    own = _labelled(docs, p)
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _labelled(docs: DataFrame, p: Plan) -> DataFrame:
    """doc_id, row, n, node, label of the node's component and its component_id for each row."""
    rows = durable(_sets(docs, p, full=False))
    nodes = durable(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "row")).alias("at"), F.first("n").alias("n"), F.first("own").alias("own")))
    labels = components_of(docs, nodes, p)
    named = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    named = durable(named.join(named.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("node", "label", "component_id"))
    return rows.select("doc_id", "row", "n", "node").join(named, "node", "left")


def components_of(docs: DataFrame, nodes: DataFrame, p: Plan) -> DataFrame:
    """(node, label) of the nodes that have links, from (node, at, n, own); ``at`` is the id and text hash of one row of the node."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                own = keys(sig, p)
                yield pa.RecordBatch.from_arrays([pa.array(own.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), own.shape[1]))], ["key", "node"])

    all_keys = nodes.select("node", "own").mapInArrow(emit, "key long, node long")
    shared = durable(all_keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("key", "first"))
    members = durable(all_keys.join(shared, "key"))

    # Who may have a link at all, with full sets, computed once from their texts.
    sig = nodes.select("node", "n", "own")
    star = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    busy = members.select("node").distinct()
    places = nodes.join(busy, "node").select(F.col("at.doc_id").alias("at_id"), F.col("at.row").alias("at_row"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _row().alias("row"))
    texts = texts.join(places, F.col("row").eqNullSafe(F.col("at_row")) & F.col("doc_id").eqNullSafe(F.col("at_id")), "left_semi")
    full = _sets(texts, p, full=True).select("node", F.col("own").alias("set")).where("node is not null").dropDuplicates(["node"])
    full = durable(full.join(busy, "node", "left_semi"))

    # Each bucket's members against its least one.
    a, b = sig.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("own").alias("sa")), sig.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("own").alias("sb"))
    close = star.join(a, "a").join(b, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p.percent)
    close = _within(close, p).select("a", "b")
    sa, sb = full.select(F.col("node").alias("a"), F.col("set").alias("sa")), full.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    met = close.join(sa, "a").join(sb, "b").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    links = durable(met.where(_linked(F.col("i"), F.col("na"), F.col("nb"), p.percent)).select("a", "b"))
    labels = components(links)

    # Buckets that hold several components still: members against members.
    mixed = members.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = durable(mixed)
    open_ = mixed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members")).where("lo < hi and members > 2").select("key")
    active = durable(_active(mixed.join(open_, "key").join(sig, "node"), p))
    more = _forests(active.join(full, "node"), p)
    links = links.union(durable(more))
    return components(links)


def _within(pairs: DataFrame, p: Plan) -> DataFrame:
    """Pairs (…, sa, sb) of signatures within the plan's distance, compared a batch at a time."""
    names = pairs.columns
    i, j = names.index("sa"), names.index("sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for k in (i, j))
                yield batch.filter(pa.array((x != y).sum(1) <= p.distance))

    return pairs.mapInArrow(run, pairs.schema)


def _blocks(rows: DataFrame, weight) -> DataFrame:
    """Rows of (key, node, …) once for each pair of blocks (i <= j) of their key that they are in, dealt by key and pair.

    The size of a key is joined by the key; without the deal after it all blocks of a key would stand in one task.
    """
    size = rows.groupBy("key").agg(F.ceil(F.sum(weight) / F.lit(BLOCK)).cast("int").alias("blocks"))
    own = rows.join(size, "key").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int"))
    return own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks").repartition("key", "i", "j")


def _active(rows: DataFrame, p: Plan) -> DataFrame:
    """(key, node, label) of the members that have another component's member within the signature distance in their bucket."""
    width = p.chunks * p.symbols

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["own"]), np.uint32).reshape(-1, width)
        n, labels = pdf["n"].to_numpy(), pdf["label"].to_numpy()
        hit = np.zeros(len(pdf), bool)
        for x in range(len(pdf) - 1):
            rest = slice(x + 1, None)
            other = np.flatnonzero((labels[rest] != labels[x]) & (np.minimum(n[rest], n[x]) * 100 >= np.maximum(n[rest], n[x]) * p.percent)) + x + 1
            if len(other):
                near = other[(sig[other] != sig[x]).sum(1) <= p.distance]
                hit[near] = True
                hit[x] |= len(near) > 0
        return pdf.loc[hit, ["key", "node", "label", "n"]]

    own = _blocks(rows, F.lit(BLOCK // 2000))
    return own.groupBy("key", "i", "j").applyInPandas(run, "key long, node long, label long, n long").distinct()


def _forests(rows: DataFrame, p: Plan) -> DataFrame:
    """Links (a, b) among the members of each bucket that connect components which nothing connects yet: a spanning forest of each pair of blocks."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, labels = pdf["node"].to_numpy(), pdf["label"].to_numpy()
        sizes = np.array([len(s) for s in pdf["set"]])
        values, codes = np.unique(np.concatenate(list(pdf["set"])), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        mark = np.zeros(len(values), bool)
        _, group = np.unique(labels, return_inverse=True)
        group = group.copy()
        out = []
        for x in np.argsort(-np.bincount(group)[group], kind="stable")[::-1]:  # members of small components first; the largest one is only compared with
            mine = codes[starts[x] : ends[x]]
            other = np.flatnonzero((group != group[x]) & (np.minimum(sizes, sizes[x]) * 100 >= np.maximum(sizes, sizes[x]) * p.percent))
            if not len(other):
                continue
            mark[mine] = True
            i = np.add.reduceat(mark[codes].astype(np.int64), starts)[other]
            mark[mine] = False
            for y in other[_linked(i, sizes[other], sizes[x], p.percent)]:
                if group[y] != group[x]:
                    out.append((nodes[x], nodes[y]))
                    group[group == group[y]] = group[x]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _blocks(rows, F.col("n")).groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()


def dedup(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: the one of the least id, ids that are null last; of equal rows one stays.

    Rows without shingles are linked with nothing and stay, whatever their ids.
    """
    own = durable(_labelled(docs, plan(k, percent)))
    each = own.where("node is not null").groupBy("label", "doc_id", "row").agg(F.count("*").alias("rows"))
    first = each.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "rows")).alias("at")).select("at.doc_id", "at.row", "at.rows")
    bare = own.where("node is null").select("doc_id", "row", F.lit(1).cast("long").alias("rows")).distinct()
    kept = durable(first.unionByName(bare).select(F.col("doc_id").alias("_quireline_id"), F.col("row").alias("_quireline_row"), F.col("rows").alias("_quireline_rows")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_quireline_id")) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col("_quireline_row"))
    if not kept.where("_quireline_rows > 1").limit(1).count():
        return docs.join(kept, same, "left_semi")
    single, more = (docs.join(kept.where(w), same) for w in ("_quireline_rows = 1", "_quireline_rows > 1"))
    return single.select(*(docs[c] for c in docs.columns)).unionByName(more.dropDuplicates(["_quireline_id", "_quireline_row"]).select(*(docs[c] for c in docs.columns)))
