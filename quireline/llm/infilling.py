"""Fill-in-the-middle: a text's units are rows, and where a text is cut is a running sum over them.

A text is ``[A-Za-z]+|[^A-Za-z]`` units in a row. Cuts are asked for by the ordinal of a unit; where a cut stands in code
points is the running sum of unit lengths up to that unit. Units are first dealt in segments of ``SEGMENT``: running sums
over the lengths of all segments find each segment's start, requests are joined by ordinal with the segments that hold
them, and only those are dealt unit by unit, with running sums and a join by ordinal again. So a document makes a row for
each ``SEGMENT`` units and for each unit of two segments, however long it is; no group grows but by one row a segment.

Whole texts are shuffled once. Rows that repeat (same id, same text) are one row with a count until the end, when they are
dealt out again, so a hot one isn't one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Units that are dealt together; possessive, as a run of letters is never cut.
SEGMENT = 64
_SEGMENT = f"(?:[A-Za-z]++|[^A-Za-z]){{1,{SEGMENT}}}"

#: The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares, in percent: of texts that are cut, and of these of the form suffix, prefix, middle.
CUT, SUFFIX_FIRST = 90, 20

_KEY = ("_k1", "_k2")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _drawn(doc_id: Column, seed: int, k: int) -> Column:
    """The k-th number (0 to 3) drawn for an id: eight hexadecimal digits of a digest of seed and id; a null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def _kept_rows(docs: DataFrame) -> DataFrame:
    """(_k1, _k2, row, copies): each different (id, text) once, under 128 bits of both; a null text is an empty one."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    said = (F.col("doc_id").isNull(), "doc_id", "text")
    keyed = own.select(F.xxhash64(*said).alias("_k1"), F.xxhash64("text", F.lit(7), *said).alias("_k2"), F.struct("doc_id", "text").alias("row"))
    # no branch below may prune a column, or texts would be shuffled once for each
    return keyed.groupBy(*_KEY).agg(F.first("row").alias("row"), F.count("*").alias("copies")).where("copies > 0")


def _planned(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with n, form, and the numbers of units before the first and the second cut (``cut1``, ``cut2``)."""
    text, doc_id = F.col("row.text"), F.col("row.doc_id")
    sized = rows.select("*", _matches(text, _SEGMENT).alias("_segments"))
    n = F.when(F.size("_segments") == 0, 0).otherwise((F.size("_segments") - 1) * SEGMENT + F.size(_matches(F.element_at("_segments", -1), UNIT)))
    sized = sized.select(*rows.columns, n.cast("long").alias("n"))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (_drawn(doc_id, seed, 2) % 100 >= CUT)
    form = F.when(plain, "plain").when(_drawn(doc_id, seed, 3) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    a, b = _drawn(doc_id, seed, 0) % (F.col("n") + 1), _drawn(doc_id, seed, 1) % (F.col("n") + 1)
    return sized.select("*", form.alias("form"), F.least(a, b).alias("cut1"), F.greatest(a, b).alias("cut2"))


def offsets(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """(_k1, _k2, cut1, cut2, start, end): code points before the first and the second cut.

    ``rows`` have texts, ``requests`` the units before each cut, 0 to n; both are dealt by key, so nothing is shuffled here.
    A cut before all units has no row to join with and is at 0.
    """
    segments = rows.select(*_KEY, F.posexplode(_matches(F.col("row.text"), _SEGMENT)).alias("segment", "units"))
    so_far = F.sum(F.length("units")).over(Window.partitionBy(*_KEY).orderBy("segment"))
    segments = segments.select("*", (so_far - F.length("units")).alias("before"))
    of = lambda cut: F.floor((F.col(cut) - 1) / SEGMENT).cast("int")
    wanted = requests.select(*_KEY, "cut1", "cut2", F.array(of("cut1"), of("cut2")).alias("_in"))
    held = segments.join(wanted, list(_KEY), "inner").where(F.array_contains("_in", F.col("segment"))).drop("_in")
    units = held.select(*_KEY, "cut1", "cut2", "segment", "before", F.posexplode(_matches(F.col("units"), UNIT)).alias("place", "unit"))
    ordinal = F.col("segment").cast("long") * SEGMENT + F.col("place") + 1
    ends = F.col("before") + F.sum(F.length("unit")).over(Window.partitionBy(*_KEY, "segment").orderBy("place"))
    units = units.select(*_KEY, "cut1", "cut2", ordinal.alias("ordinal"), ends.alias("ends"))
    at = lambda cut: F.coalesce(F.max(F.when(F.col("ordinal") == F.col(cut), F.col("ends"))), F.lit(0).cast("long"))
    return units.groupBy(*_KEY).agg(at("cut1").alias("start"), at("cut2").alias("end"))


def infilled(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, text, output: a row for each row of ``docs``.

    n units are cut twice, at numbers drawn from the id: prefix, middle, suffix. ``output`` is the text itself (plain), or
    its parts behind marks in the order prefix, suffix, middle (psm) or suffix, prefix, middle (spm). Plain are empty and
    null texts, those that hold a mark, and the share that the id draws; their prefix_chars and middle_chars are null. Rows
    that share an id are cut by the same draw, each in its own text; rows that repeat come out as often as they came in; a
    null id draws as an empty one. Other columns aren't read, whatever their names. An empty table has no rows.
    """
    rows = _planned(_kept_rows(docs), seed)
    cuts = offsets(_kept_rows(docs), rows.where("form <> 'plain'").select(*_KEY, "cut1", "cut2"))
    at = lambda c: F.when(F.col("form") != "plain", F.coalesce(F.col(c), F.lit(0)).cast("int"))
    out = rows.join(cuts, list(_KEY), "left").select(F.col("row.doc_id").alias("doc_id"), "n", "form", F.col("row.text").alias("text"), "copies", at("start").alias("_a"), at("end").alias("_b"))
    prefix, middle = F.substring("text", F.lit(1), F.col("_a")), F.substring("text", F.col("_a") + 1, F.col("_b") - F.col("_a"))
    suffix = F.substring("text", F.col("_b") + 1, F.length("text"))
    output = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).otherwise(F.col("text"))
    out = out.select("doc_id", "n", "form", F.col("_a").cast("long").alias("prefix_chars"), (F.col("_b") - F.col("_a")).cast("long").alias("middle_chars"), "text", output.alias("output"), "copies")
    return out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy")).drop("copies", "_copy")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from output and form alone: its parts stand between the marks, which no cut text holds."""
    mark = lambda m: F.instr(output, m)
    between = lambda a, b: F.substring(output, mark(a) + len(a), mark(b) - mark(a) - len(a))
    middle = F.substring(output, mark(MIDDLE) + len(MIDDLE), F.length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and digests of the output and of the text that is restored from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
