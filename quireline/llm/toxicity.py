"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Suspicious runs (look-alike characters inside words, letters spaced out, letters drawn out) become a lattice of what
each character may stand for, and Viterbi decoding under a character trigram model picks the likeliest readings: for
every pair of last letters the best paths are kept, so none that could win is lost, and runs are decoded whole. The model's counts are taken over every whole text of the corpus. The restored text, that is the text with those readings
beside it, is scored by how strongly its words and character n-grams speak for the toxic class among labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm import subwords
from quireline.llm.common import held_out

ORDERS = (subwords.WORD, 4, 5, 6, 8)
#: Bits of a feature's hash.
BITS = 31
#: Labelled rows of each class that are learned from at most: the bound of the sample, a parameter of ``train``.
PER_CLASS = 4000
THRESHOLD = 0.5
#: Readings of a run that are scored, and so the paths kept for every state of the decoder.
READINGS = 3
#: Toxic texts that a learned feature must be in; which of those speak for the class, the bound of their log odds says.
LEAST_TEXTS = 5

# Letters of the character model, and what look-alike characters may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "§": "s", "¡": "i", "*": "aeiou", "#": "aeiou"}
GAPS = " .-_*'~,"

_ALPHABET = len(LETTERS) + 2  # 0 is the edge of a word, the last anything else
_CODE = {c: k for k, c in enumerate(LETTERS, 1)}
_LOOK = re.escape("".join(LOOKS))
_SPACED = re.compile(r"(?:[^\W_]|[@$!|])(?:[ .\-_*~](?:[^\W_]|[@$!|])){3,}(?!\w)")  # letters spaced out
_IN_TOKEN = re.compile(
    rf"(?<!\S)[^\W\d_]*(?:[{_LOOK}]+[^\W\d_]+)+[{_LOOK}]*(?!\w)"  # look-alikes before or between letters
    rf"|(?<!\S)[^\W\d_]{{2,}}[0-9@$](?![\w@$])"  # one at the end
    rf"|(?<!\S)[^\W\d_]+(?:[.\-_*~][^\W\d_]+)+(?!\w)"  # broken up
    r"|[^\W\d_]*([^\W\d_])\1{2,}[^\W\d_]*"  # drawn out
)
# What the patterns above can't do without, quick to look for: a sign beside a letter; a letter alone beside others.
_SIGN = re.compile(rf"[{_LOOK}.\-_~](?:(?=[^\W\d_])|(?<=[^\W\d_][0-9@$])(?![\w@$]))")
_ALONE = re.compile(r"\s(?=(?:[^\W_]|[@$!|])(?:[ .\-_*~](?:[^\W_]|[@$!|])){3})")
_TOKEN_END = re.compile(r"\s|\Z")


def suspicious(low: str) -> list[str]:
    """Runs of a lower-case text that may be disguised, in order."""
    text = f" {low} "
    found: dict[int, tuple[int, str]] = {}
    for m in _ALONE.finditer(text):
        if own := _SPACED.match(text, m.end()):
            found.setdefault(m.end(), (own.end(), own[0]))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    same = codes[1:] == codes[:-1]
    drawn = np.flatnonzero(same[1:] & same[:-1] & ((codes[2:] >= 97) & (codes[2:] <= 122) | (codes[2:] >= 0xC0)))
    last = -1
    for at in sorted([*(m.start() for m in _SIGN.finditer(text)), *drawn.tolist()]):
        if at >= last:
            start = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at), text.rfind("\t", 0, at)) + 1
            last = _TOKEN_END.search(text, at).start()
            for m in _IN_TOKEN.finditer(text[start:last]):
                found.setdefault(start + m.start(), (start + m.end(), m[0]))
    out, end = [], -1
    for start in sorted(found):
        if start >= end:
            end = found[start][0]
            out.append(found[start][1])
    return out


# --- the character model


def _folded(codes: np.ndarray) -> np.ndarray:
    table = np.full(0x180, _ALPHABET - 1, np.int64)
    table[32] = 0
    for c, k in _CODE.items():
        table[ord(c)] = k
    return np.where(codes < 0x180, table[np.minimum(codes, 0x17F)], _ALPHABET - 1)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all whole texts; edges of words count as a letter. As long as the alphabet's third power."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_ALPHABET**3, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in subwords.blocks(texts):
                a = _folded(subwords.layout(texts[begin:end])[0])
                total += np.bincount((a[:-2] * _ALPHABET + a[1:-1]) * _ALPHABET + a[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = np.zeros(_ALPHABET**3, np.int64)
    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for row in found.collect():  # at most the alphabet's third power
        counts[row["gram"]] = row["n"]
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter after two others, mixed with those after one and after none."""
    n = counts.reshape(_ALPHABET, _ALPHABET, _ALPHABET).astype(np.float64)
    one = n.sum((0, 1)) + 1
    two = n.sum(0)
    p1 = one / one.sum()
    p2 = (two + 8 * p1) / (two.sum(1, keepdims=True) + 8)
    p3 = (n + 8 * p2[None]) / (n.sum(2, keepdims=True) + 8)
    return np.log(p3)


# --- the channel


def _choices(run: str) -> list[list[tuple[int | None, float]]]:
    """For each character what it may stand for (a letter, an edge as 0, nothing as None) and the log probability."""
    out = []
    for k, c in enumerate(run):
        drawn = k > 0 and c == run[k - 1]
        if c in _CODE:
            out.append([(_CODE[c], -0.1)] + ([(None, -0.3)] if drawn else []))
        elif c == " ":
            out.append([(None, -0.4), (0, -1.2)])
        else:
            own = [(_CODE[x], -1.0) for x in LOOKS.get(c, "")]
            if c in GAPS or drawn:
                own.append((None, -0.5))
            out.append(own or [(_ALPHABET - 1, -0.5)])
    return out


def readings(run: str, model: list, n: int = READINGS) -> list[str]:
    """The n likeliest readings of a suspicious run in lower case, best first.

    A state is the last two letters; its n best paths of different text are kept at each character, however long the run.
    The model is ``log_model`` as nested lists, which single lookups are quicker in.
    """
    states: dict[tuple[int, int], list[tuple]] = {(0, 0): [(0.0, 0, None)]}  # log probability, hash of the text, (text before, letter)
    for options in _choices(run):
        grown: dict[tuple[int, int], list[tuple]] = {}
        for (a, b), paths in states.items():
            after = model[a][b]
            for letter, cost in options:
                if letter is None:
                    grown.setdefault((a, b), []).extend((s + cost, h, t) for s, h, t in paths)
                else:
                    cost += after[letter]
                    grown.setdefault((b, letter), []).extend((s + cost, (h * 0x9E3779B97F4A7C15 + letter + 1) & 0xFFFFFFFFFFFFFFFF, (t, letter)) for s, h, t in paths)
        states = {state: paths if len(paths) == 1 else _best(paths, n) for state, paths in grown.items()}
    return [_said(t) for _, _, t in _best([(s + model[a][b][0], h, t) for (a, b), paths in states.items() for s, h, t in paths], n)]


def _best(paths: list[tuple], n: int) -> list[tuple]:
    """The n likeliest of different text; ties by the hash of the text."""
    out: dict[int, tuple] = {}
    for path in sorted(paths, key=lambda p: (-p[0], p[1])):
        if path[1] not in out:
            out[path[1]] = path
            if len(out) == n:
                break
    return list(out.values())


def _said(text: tuple | None) -> str:
    out = []
    while text is not None:
        text, letter = text
        out.append(" " if letter == 0 else LETTERS[letter - 1] if letter < _ALPHABET - 1 else "?")
    return "".join(reversed(out))


def restored(text: str | None, read) -> str:
    """The text, and after it the readings of its suspicious runs."""
    if not text:
        return ""
    low = text.lower()
    more = [r for run in suspicious(low) for r in read(run) if r != run]
    return f"{low} {' '.join(more)}" if more else low


# --- the score


class Lexicon:
    """Strength of features for the toxic class by their hash; a small table tells most others apart at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[keys >> (BITS - 20)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hashes are known, their places among the keys)."""
        at = np.flatnonzero(self.maybe[hashes >> (BITS - 20)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        known = self.keys[k] == hashes[at]
        return at[known], k[known]


@dataclass(frozen=True)
class Model:
    """A document's score is a logistic function of its strongest feature and of how many are strong."""

    trigrams: np.ndarray
    lexicon: Lexicon
    coefficients: tuple[float, ...]


#: From this strength on a feature counts as strong.
STRONG = 2.0
NOTHING = (np.zeros(0, np.int32), np.zeros(0, np.float32))


def evidence(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Of each text: its strongest feature, log of 1 + number of strong ones, log of 1 + strength of all its words, log of 1 + words.

    A word is as strong as the strongest feature that begins in it or at the space before it.
    """
    out = []
    for begin, end in subwords.blocks(texts):
        codes, starts = subwords.layout(texts[begin:end])
        space = codes == 32
        word = np.cumsum(space[:-1] & ~space[1:])  # the number of the word that each place, or the space before it, belongs to
        word = np.append(word, word[-1:])
        best = np.zeros(int(word[-1]) + 1 if len(word) else 1, np.float32)
        many = np.zeros(len(starts))
        for at, hashes in subwords.grams(codes, ORDERS, BITS):
            known, k = lexicon.find(hashes)
            value = lexicon.values[k]
            np.maximum.at(best, word[at[known]], value)
            many += np.bincount(np.searchsorted(starts, at[known], "right") - 1, value >= STRONG, len(starts))
        first = np.append(word[starts] - (space[starts] & ~space[starts + 1]), len(best) - 1)  # words up to each text's begin
        total = np.concatenate(([0.0], np.cumsum(best[1:], dtype=np.float64)))
        n = np.diff(first)
        top = np.zeros(len(starts))
        held = np.flatnonzero(n)
        if len(held):
            top[held] = np.maximum.reduceat(best[1:], first[:-1][held])
        out.append(np.stack([top, np.log1p(many), np.log1p(total[first[1:]] - total[first[:-1]]), np.log1p(n)], 1))
    return np.concatenate(out) if out else np.zeros((0, 4))


def _reader(trigrams: np.ndarray):
    model = trigrams.tolist()
    return lru_cache(200_000)(lambda run: readings(run, model))


def _own(text: str | None, read) -> np.ndarray:
    """Distinct features of a restored text."""
    return np.unique(np.concatenate([np.zeros(0, np.int32), *(h for _, h in subwords.grams(subwords.layout([restored(text, read)])[0], ORDERS, BITS))]))


def lexicon_of(toxic: DataFrame, clean: DataFrame, trigrams: np.ndarray, n1: int, n0: int) -> Lexicon:
    """Features of ``LEAST_TEXTS`` toxic texts or more, with the lower bound of their log odds where that is over 0.

    Their number is bounded by the sample's. Reads ``text`` of both.
    """
    shared = toxic.sparkSession.sparkContext.broadcast(trigrams)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                own = [_own(t, read) for t in whole.slice(at, 256).column(0).to_pylist()]
                h, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int32()), pa.array(n, pa.int64())], ["h", "n"])

    found = toxic.select("text").mapInArrow(first, "h int, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS).toArrow()
    keys, yes = found.column(0).to_numpy(), found.column(1).to_numpy()
    order = np.argsort(keys)
    keys, yes = keys[order], yes[order]
    known = toxic.sparkSession.sparkContext.broadcast(Lexicon(keys, yes))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, lexicon = _reader(shared.value), known.value
        total = np.zeros(len(lexicon.keys), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[lexicon.find(_own(text, read))[1]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["k", "n"])

    rows = clean.select("text").mapInArrow(second, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    no = np.zeros(len(keys), np.int64)
    no[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    odds = np.log((yes + 0.5) / (n1 + 1)) - np.log((no + 0.5) / (n0 + 1)) - 1.64 * np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
    return Lexicon(keys[odds > 0], odds[odds > 0].astype(np.float32))


def fit(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, ...]:
    """Logistic regression of y by Newton steps with a small ridge, weighted to a population with that share of 1; the intercept is last."""
    w = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    z = np.column_stack([x, np.ones(len(x))])
    c = np.zeros(z.shape[1])
    for _ in range(100):
        p = subwords.sigmoid(z @ c)
        gradient = z.T @ (w * (y - p)) - 0.05 * c
        curve = (z * (w * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(c))
        step = np.linalg.solve(curve, gradient)
        c += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in c)


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Learns from at most ``per_class`` labelled rows of each class that aren't held out; character counts are of all texts.

    Two thirds of the sample weigh features, the rest sets the logistic function, so it isn't fooled by features that only
    their own document has. Without rows of both classes every score is that class's, or 0.5 without labels.
    """
    trigrams = log_model(trigram_counts(docs))
    no, yes = subwords.class_counts(labels, column)
    if not no or not yes:
        return Model(trigrams, Lexicon(*NOTHING), (0.0, 0.0, 0.0, 0.0, 40.0 * ((yes > 0) - (no > 0))))
    sample = subwords.labelled_sample(labels, column, per_class)
    own = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * per_class rows at most
    own = own.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)))
    weigh, settle = own.where("part < 2"), own.where("part = 2").select("y", "text")
    sizes = {r["y"]: r["n"] for r in weigh.groupBy("y").agg(F.count("*").alias("n")).collect()}
    lexicon = lexicon_of(weigh.where("y = 1"), weigh.where("y = 0"), trigrams, sizes.get(1, 0), sizes.get(0, 0))
    shared = docs.sparkSession.sparkContext.broadcast((trigrams, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(shared.value[0])
        for batch in batches:
            x = evidence([restored(t, read) for t in batch.column(1).to_pylist()], shared.value[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, k]) for k in range(4))], ["y", "a", "b", "c", "d"])

    rows = settle.mapInArrow(run, "y int, a double, b double, c double, d double").toArrow()  # a third of the sample at most
    y = rows.column(0).to_numpy().astype(float)
    if len(y) == 0 or y.min() == y.max():
        return Model(trigrams, lexicon, (1.0, 0.5, 0.0, 0.0, -4.0))
    x = np.column_stack([rows.column(k).to_numpy() for k in range(1, 5)])
    return Model(trigrams, lexicon, fit(x, y, yes / (yes + no)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) of every whole text; the text decides alone.

    Every column and row is kept, repeated rows too; null texts are as empty ones, which have no evidence. A column of
    that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "toxicity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        read = _reader(m.trigrams)
        c = np.array(m.coefficients)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                x = evidence([restored(t, read) for t in batch.column(kept.index("text")).to_pylist()], m.lexicon)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(subwords.sigmoid(x @ c[:-1] + c[-1]), pa.float64())], [*kept, "toxicity"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*kept).dtypes)
    return docs.select(*kept).mapInArrow(run, f"{schema}, toxicity double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; see ``train`` and ``score`` for odd rows. Rows of a score are answered alike."""
    own = score(docs.select("doc_id", "text"), train(docs, labels))
    return own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
