"""Secret scans: fixed patterns, and the guess cost of values that stand where credentials stand.

The guess cost of a value is the least cost of a segmentation into words, dates, repeats, keyboard walks and
brute-force spans, found by dynamic programming in powers of ten of guesses. A word costs as many guesses as the corpus
has text for one occurrence of it, so a value that is made of its vocabulary is cheap and a random one is dear. Every
value in a credential's place is priced, inside the base patterns' spans too. The vocabulary is all words of the corpus:
those that some value could be made of are joined with the values, and no part of it goes to the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireline.llm.common import durable, small

#: A value in a credential's place is a secret from so many powers of ten of guesses on.
GUESSES = 10.0
#: Letters of the shortest and longest word that the segmentation looks up.
LETTERS = (3, 32)
KINDS = ("assign", "access", "hex", "guess")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more of AKIA[A-Z0-9]+
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that have 24 characters or more

# Where credentials stand.
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth(?:orization)?|login|bearer)["']?\s{0,4}(?:[:=]|\bis\b)\s{0,4}["']?([^\s"'<>,;]{6,})|://[^\s/:@]*+:([^\s/@]{6,}+)@""", re.IGNORECASE)
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "login", "bearer", "://")

# Passwords that are tried first whatever the corpus says.
COMMON = "password 123456 qwerty letmein admin welcome monkey dragon football iloveyou master login princess sunshine shadow superman batman trustno1 secret changeme default root test guest hello freedom whatever".split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

_NEAR = {c: {d for s in (-1, 0, 1) for t in (-1, 0, 1) if 0 <= r + s < 4 and 0 <= k + t < len(ROWS[r + s]) for d in ROWS[r + s][k + t]} for r, row in enumerate(ROWS) for k, c in enumerate(row)}
_SEP = r"[-/._]?"
_DATE = re.compile(rf"(?:(?:19|20)\d\d{_SEP}(?:0?[1-9]|1[0-2]){_SEP}(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01]){_SEP}(?:0?[1-9]|1[0-2]){_SEP}(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d)")
_LEET = str.maketrans("013457@$!", "oieastasi")
_LETTERS = re.compile(r"[^\W\d_]{%d,}" % LETTERS[0])
_COMMON = {w: k for k, w in enumerate(dict.fromkeys(COMMON), 1)}


def _brute(span: str) -> float:
    """Powers of ten of guesses of a span of which nothing is known but its classes of characters."""
    size = 26 * any(c.islower() for c in span) + 26 * any(c.isupper() for c in span) + 10 * any(c.isdigit() for c in span) + 33 * any(not c.isalnum() for c in span)
    return len(span) * math.log10(max(size, 10))


def guess_cost(value: str, ranks: dict[str, float]) -> float:
    """Least powers of ten of guesses over all segmentations of the value; ``ranks`` has the guesses that words take.

    >>> guess_cost("password", {}) < 2 < guess_cost("x9#Kq2!v", {})
    True
    """
    low, n = value.lower(), len(value)
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # least cost of a segmentation whose last part is a brute-force span, for spans of one more character
    per = _brute(value) / n if n else 0.0
    same = [0] * 17  # how many characters up to this end are those of so many places before
    for end in range(1, n + 1):
        brute[end] = min(brute[end - 1] + per, best[end - 1] + per + 0.3)
        cost = brute[end]
        for start in range(max(0, end - LETTERS[1]), end - 1):
            size = end - start
            own = min(
                _word(value[start:end], low[start:end], plain[start:end], ranks) if size >= 3 else math.inf,
                _date(low[start:end]) if 4 <= size <= 10 else math.inf,
                _walk(low[start:end]) if size >= 4 else math.inf,
            )
            cost = min(cost, best[start] + own)
        for unit in range(1, min(16, end - 1) + 1):  # a unit and its repeats before this end
            same[unit] = same[unit] + 1 if low[end - 1] == low[end - 1 - unit] else 0
            times = 1 + same[unit] // unit
            if times >= 2 and times * unit >= 3:
                cost = min(cost, best[end - times * unit] + _brute(low[end - unit : end]) + math.log10(times))
        best[end] = cost
    return best[n]


def _word(own: str, low: str, plain: str, ranks: dict[str, float]) -> float:
    case = 0.0 if own == low else 0.3 if own[0].isupper() and own[1:] == low[1:] or own.isupper() else 0.3 * sum(c.isupper() for c in own)
    found = [math.log10(1 + ranks[w]) + extra for w, extra in ((low, 0.0), (plain, 0.6), (low[::-1], 0.3)) if w in ranks]
    return min(found) + case if found else math.inf


def _date(low: str) -> float:
    return math.log10(365 * 60) if _DATE.fullmatch(low) and len(low) > 4 else math.log10(120) if _DATE.fullmatch(low) else math.inf


def _walk(low: str) -> float:
    turns, before = 1, None
    for a, b in zip(low, low[1:], strict=False):
        if b not in _NEAR.get(a, ()):
            return math.inf
        step = (ord(b) - ord(a)) if a != b else 0
        turns += step != before
        before = step
    return math.log10(47 * len(low)) + turns * math.log10(2)


def parts(value: str) -> set[str]:
    """What of the value, as it is, with look-alikes read as letters, or backwards, could be a word.

    >>> sorted(parts("a1bc-de"))
    ['aib', 'aibc', 'ibc']
    """
    low = value.lower()
    least, most = LETTERS
    runs = {m[0] for own in (low, low.translate(_LEET), low[::-1]) for m in _LETTERS.finditer(own)}
    return {run[k : k + n] for run in runs for k in range(len(run) - least + 1) for n in range(least, min(most, len(run) - k) + 1)}


def _words(text: Column) -> Column:
    return F.explode(F.split(F.lower(text), r"[^\p{L}]+"))


def vocabulary(docs: DataFrame, placed: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(w, guesses) of every word of the whole texts, or of the ``wanted`` ones (w): characters of text for each of its own.

    Values in a credential's place are no words of the corpus, so those of ``placed`` (value) are taken off again.
    """
    text = F.col("text").cast("string")
    size = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    each = docs.select(_words(text).alias("w"), F.lit(1).alias("n")).unionAll(placed.select(_words(F.col("value")).alias("w"), F.lit(-1).alias("n")))
    each = each.where(F.length("w").between(*LETTERS))
    if wanted is not None:
        each = each.join(small(wanted), "w", "left_semi")
    return each.groupBy("w").agg(F.sum("n").alias("n")).where("n > 0").select("w", (F.lit(float(size)) / (F.col("n") * (F.length("w") + 1))).alias("guesses"))


def priced(placed: DataFrame, docs: DataFrame, least: float = GUESSES) -> DataFrame:
    """(value, cost) of the distinct values of ``placed`` (value) that cost ``least`` or more under the vocabulary of ``docs``."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # more words only make a value cheaper, so those that are cheap without any are done with
            own = [v for v in batch.column(0).to_pylist() if guess_cost(v, _COMMON) >= least]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([sorted(parts(v)) for v in own], pa.list_(pa.string()))], ["value", "parts"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost = [guess_cost(v, {x["w"]: x["guesses"] for x in known or ()} | _COMMON) for v, known in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.float64())], ["value", "cost"])

    dear = durable(placed.select("value").distinct().mapInArrow(alone, "value string, parts array<string>"))
    pairs = dear.select("value", F.explode("parts").alias("w"))
    words = vocabulary(docs, placed, pairs.select("w").distinct())
    known = pairs.join(words, "w").groupBy("value").agg(F.collect_list(F.struct("w", "guesses")).alias("known"))
    return dear.select("value").join(known, "value", "left").mapInArrow(whole, "value string, cost double").where(F.col("cost") >= least)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order; kind as an index of KINDS."""
    low = text.lower()
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return sorted(found)


def places(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of what stands in a credential's place."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    return [(*m.span(k), m[k]) for m in CONTEXT.finditer(text) for k in (1 if m[1] is not None else 2,)]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end in code points, end exclusive, cost in powers of ten of guesses; by start,
    then kind) for each row of ``docs``.

    Spans of the base patterns have no cost. Reads ``doc_id`` and ``text`` alone. Null and empty texts have no spans; rows
    that repeat, or have no id, are answered each; an empty table has no rows.
    """
    base, place = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]), pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                own = [[{"start": a, "kind": k, "end": b} for a, k, b in base_spans(t)] for t in texts]
                more = [[{"start": a, "end": b, "value": v} for a, b, v in places(t)] for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(base)), pa.array(more, pa.list_(place))], ["doc_id", "base", "places"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, base array<struct<start:int,kind:int,end:int>>, places array<struct<start:int,end:int,value:string>>")
    found = durable(found.withColumn("row", F.monotonically_increasing_id()))
    placed = found.select("row", F.inline("places"))
    dear = placed.join(small(priced(placed, docs)), "value")
    dear = dear.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end", "cost")).alias("dear"))
    base_ = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("cost")))
    every = F.array_sort(F.when(F.col("dear").isNull(), base_).otherwise(F.concat(base_, "dear")))
    names = F.array(*map(F.lit, KINDS))
    say = F.transform(every, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["cost"].alias("cost")))
    return found.join(small(dear, F.size("dear")), "row", "left").select("doc_id", say.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``scan``'s rows."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    say = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(say(base).cast("binary"), 256).alias("base_sha256"), say(F.col("spans")).alias("spans"), of("guess"))
