"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed words and character n-grams; a softmax over that average
says how good it is. Vectors and output are trained by plain stochastic gradient descent in numpy, in one task over a
bounded sample of labelled rows whose features other tasks have counted. Because the output is linear in the
average, a trained model comes down to one number a bucket, and scoring to the mean of those numbers over a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm import subwords
from quireline.llm.common import held_out

ORDERS = (subwords.WORD, 2, 3, 4)
BITS = 15
#: Numbers of a vector.
WIDTH = 8
#: Labelled rows of each class that are learned from at most: the bound of the sample, a parameter of ``train``.
PER_CLASS = 2500
#: From this score on a document is good.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """Score of a text: sigmoid(mean of ``weights`` over its features + ``bias``); of one without features: sigmoid(``bias``)."""

    weights: np.ndarray
    bias: float


def features(codes: np.ndarray, starts: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    yield from subwords.grams(codes, ORDERS, bits)
    yield from subwords.repeats(codes, starts, bits)


def counted(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(y, buckets, counts) of each row of (y, text): the distinct features of a whole text, at most 2**bits of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, texts = batch.column(0), batch.column(1).to_pylist()
            idx, num = [], []
            for text in texts:
                found = np.concatenate([np.zeros(0, np.int32), *(b for _, b in features(*subwords.layout([text]), bits))])
                n = np.bincount(found, minlength=1)
                own = np.flatnonzero(n)
                idx.append(own.astype("<u4").tobytes())
                num.append(n[own].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([y, pa.array(idx, pa.binary()), pa.array(num, pa.binary())], ["y", "buckets", "counts"])

    return docs.mapInArrow(run, "y int, buckets binary, counts binary")


def descend(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, width: int = WIDTH, epochs: int = 6, batch: int = 32, rate: float = 8.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weight of each bucket and bias, by stochastic gradient descent on vectors and softmax output."""
    rng = np.random.default_rng(seed)
    size = 1 << bits
    vectors = rng.uniform(-1 / width, 1 / width, (size, width)).astype(np.float32)
    output = rng.normal(0, 0.3, (width, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    steps = max(1, epochs * ((len(rows) + batch - 1) // batch))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            own = [rows[k] for k in order[at : at + batch]]
            x = np.zeros((len(own), size), np.float32)
            for r, (_, buckets, counts) in enumerate(own):
                if len(buckets):
                    x[r, buckets] = counts / counts.sum()
            mean = x @ vectors
            logit = mean @ output + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), [y for y, _, _ in own]] -= 1
            p /= len(own)
            lr = rate * (1 - step / steps)
            back = p @ output.T
            output -= lr * 0.1 * (mean.T @ p)
            bias -= lr * 0.1 * p.sum(0)
            vectors -= lr * width * (x.T @ back)
            step += 1
    line = output[:, 1] - output[:, 0]
    return (vectors @ line).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Learns from at most ``per_class`` labelled rows of each class that aren't held out.

    Classes are sampled alike and the bias set back to their shares among all labelled rows. Without rows of both
    classes nothing can be told apart: the score is then 1 for all where only class 1 is known, 0 where only class 0
    is, and 0.5 without labels.
    """
    no, yes = subwords.class_counts(labels, column)
    if not no or not yes:
        return Model(np.zeros(1 << BITS, np.float32), 40.0 * ((yes > 0) - (no > 0)))
    sample = subwords.labelled_sample(labels, column, per_class)
    own = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * per_class rows at most
    own = own.groupBy("doc_id").agg(F.first("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))  # of rows that share an id, one
    found = descended(counted(own.select("y", "text")))
    if not found or not 0 < found["yes"] < found["rows"]:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"] + float(np.log(yes / no) - np.log(found["yes"] / (found["rows"] - found["yes"]))))


def descended(rows: DataFrame):
    """The result of ``descend`` over all of a bounded number of counted rows, trained in one task; None without rows.

    Rows are sorted by their content first, so that the order in which they arrive changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        if held:
            weights, bias = descend([(y, np.frombuffer(b, "<u4"), np.frombuffer(n, "<u4").astype(np.float32)) for y, b, n in held])
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias]), pa.array([sum(y for y, _, _ in held)], pa.int64()), pa.array([len(held)], pa.int64())], ["weights", "bias", "yes", "rows"])

    return rows.repartition(1).mapInArrow(run, "weights binary, bias double, yes long, rows long").first()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) of every whole text; the text decides alone.

    Every column and row is kept, repeated rows too; null texts are as empty ones and have the model's bias.
    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "quality_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                scores = means(batch.column(kept.index("text")).to_pylist(), m)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*kept, "quality_score"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes)
    return docs.select(*kept).mapInArrow(run, f"{schema}, quality_score double")


def keep(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns as they are, whose whole texts score ``least`` or more."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                yield batch.filter(pa.array(means(batch.column(at).to_pylist(), shared.value) >= least))

    return docs.mapInArrow(run, docs.schema)


def means(texts: list[str | None], m: Model) -> np.ndarray:
    out = []
    bits = int(np.log2(len(m.weights)))
    for begin, end in subwords.blocks(texts):
        codes, starts = subwords.layout(texts[begin:end])
        total, n = np.zeros(len(starts)), np.zeros(len(starts))
        for at, buckets in features(codes, starts, bits):
            run = np.concatenate(([0.0], np.cumsum(m.weights[buckets], dtype=np.float64)))
            cut = np.searchsorted(at, np.append(starts, len(codes)))
            total += run[cut[1:]] - run[cut[:-1]]
            n += np.diff(cut)
        out.append(subwords.sigmoid(total / np.maximum(n, 1) + m.bias))
    return np.concatenate(out) if out else np.zeros(0)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    own = score(docs.select("doc_id", "text"), train(docs, labels))
    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
