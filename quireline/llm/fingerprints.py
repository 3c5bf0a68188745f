"""I-Match document fingerprints, in DataFrame operations alone.

Terms of middling document frequency carry a text's identity. The lexicon is a fixed number of hashed terms, counted over
every whole text; those within a band of document frequency are kept, as one bitmap. A text's distinct kept terms, sorted,
are hashed once as they are and once for each of several random subsets of the lexicon: small subsets see only a few terms,
so their hashes outlast edits elsewhere, and the share of subsets that agree says how alike two texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a hashed term: the lexicon has 2**BITS entries, whatever the input.
BITS = 20
#: Share of documents that have a term: its idf is between log(1 / HIGH) and log(1 / LOW).
LOW, HIGH = 0.001, 0.2
#: The random subsets of each density: those of density s have one term in 2**s of the lexicon.
DENSITIES = {2: 4, 3: 6, 4: 7, 5: 7, 6: 7, 7: 7, 8: 7, 9: 4}
SUBSETS = [s for s, n in DENSITIES.items() for _ in range(n)]
#: Documents in a range of ids, about, and the most ranges that there are.
RANGE, RANGES = 2000, 10_000


def _terms(text: Column) -> Column:
    """Distinct hashed words of a text; words are runs between white space, in lower case."""
    words = F.split(F.translate(F.lower(text), "\n\t\r", "   "), " ")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w).bitwiseAND((1 << BITS) - 1).cast("int")))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> Column:
    """2**BITS flags, 32 to a number, of the hashed terms whose document frequency is in the band, as a constant of that fixed size."""
    total = docs.count()
    df = docs.select(F.explode(_terms(F.col("text").cast("string"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    kept = df.where(F.col("df").between(max(2, low * total), max(2, high * total)))
    words = kept.groupBy(F.shiftright("term", 5).alias("at")).agg(F.expr("bit_or(shiftleft(1L, term & 31))").alias("flags"))
    flags = [0] * (1 << (BITS - 5))
    for row in words.collect():  # 2**BITS / 32 rows at most, whatever the input
        flags[row["at"]] = row["flags"]
    return F.split(F.lit(",".join(map(str, flags))), ",").cast("array<bigint>")  # folded to one constant when planned


def _subset(terms: Column, k: int, s: int) -> Column:
    return F.filter(terms, lambda t: F.xxhash64(t, F.lit(k)).bitwiseAND((1 << s) - 1) == 0)


def with_fingerprint(rows: DataFrame, text: str, name: str, bits: Column) -> DataFrame:
    """Adds the fingerprint of a text column: the hash of all kept terms, then one of each subset, "-" where it has none of them.

    A text without kept terms is hashed as it is, so that equal texts agree and others don't.
    """
    kept = F.filter(_terms(F.col(text)), lambda t: F.get(bits, F.shiftright(t, 5)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(31))) != 0)
    some = [_subset(F.col("_kept"), k, s) for k, s in enumerate(SUBSETS)]
    whole = F.when(F.size("_kept") == 0, F.xxhash64(F.lit("text"), text)).otherwise(F.xxhash64("_kept"))
    say = lambda h, n: F.substring(F.lower(F.lpad(F.hex(h), 16, "0")), 1, n)
    parts = [F.transform(F.array(own), lambda s: F.when(F.size(s) == 0, F.lit("-")).otherwise(say(F.xxhash64(s), 8)))[0] for own in some]
    return rows.withColumn("_kept", F.array_sort(kept)).withColumn(name, F.concat_ws(":", say(whole, 16), *parts)).drop("_kept")


def likeness(a: str, b: str) -> Column:
    """From 0 to 1: of the densities, the best share of subsets that agree among those with terms in either text; 1 for equal fingerprints.

    Dense subsets of long texts never outlast an edit and sparse ones of short texts are mostly empty, so the density that
    suits the texts speaks for them.
    """
    pairs = F.arrays_zip(F.split(a, ":").alias("x"), F.split(b, ":").alias("y"))
    shares, at = [], 2  # the first subset stands second
    for n in DENSITIES.values():
        own = F.slice(pairs, at, n)
        held = F.size(F.filter(own, lambda p: (p["x"] != "-") | (p["y"] != "-")))
        same = F.size(F.filter(own, lambda p: (p["x"] != "-") & (p["x"] == p["y"])))
        shares.append(F.when(held < 2, 0.0).otherwise(same / held))
        at += n
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(F.greatest(*shares))


def _ranges(rows: DataFrame) -> Column:
    """The number of the range that a row (doc_id, _tie) belongs to; higher ones are first in order.

    Bounds are quantiles of the ids, so ranges hold about as many rows however ids lie. Of an id that fills several
    ranges, and of null ids, rows are dealt over these by the tie, in its order.
    """
    stats = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    m = max(1, min(RANGES, stats["n"] // RANGE))
    bounds = rows.agg(F.percentile_approx("doc_id", [k / m for k in range(1, m)], 100_000).alias("b")).first()["b"] if m > 1 and stats["known"] else []
    step = max(1, int(len(bounds) ** 0.5))
    held = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    tops = F.split(F.lit(",".join(map(str, bounds[step - 1 :: step]))), ",").cast("array<bigint>")
    share = F.lit(0.5) - F.col("_tie") / F.lit(2.0**64)  # from 1 to 0 as the tie grows

    def below(than) -> Column:  # how many bounds are so, found among every so many bounds first
        whole = F.size(F.filter(tops, than)) * step
        return whole + F.size(F.filter(F.slice(held, whole + 1, F.lit(step)), than))

    def dealt(low: Column, n: Column) -> Column:
        return low + F.least(F.floor(share * n), n - 1)

    if not bounds:
        low, n = F.lit(0).cast("long"), F.lit(1).cast("long")
    else:
        low = below(lambda b: b < F.col("doc_id")).cast("long")
        n = below(lambda b: b <= F.col("doc_id")).cast("long") - low + 1
    nulls = max(1, (stats["n"] - stats["known"]) * m // max(1, stats["n"]))
    return F.when(F.col("doc_id").isNull(), dealt(F.lit(-nulls).cast("long"), F.lit(nulls).cast("long"))).otherwise(dealt(low, n))


def with_next(rows: DataFrame, *columns: str, tie: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``next_<column>`` of the next row by descending doc_id; after the last comes the first, and a lone row follows itself.

    Rows are dealt by ranges of ids, and the head of each range is a guest at the end of the range before it, so no window
    holds much more than a range. Equal ids are in the order of a hash of the columns ``tie``, else of all named; null ids
    come last; rows that are the same in all of these stand beside each other in any order.
    """
    placed = rows.withColumn("_tie", F.xxhash64(*(tie or columns)))
    placed = placed.withColumn("_range", _ranges(placed.select("doc_id", "_tie")))
    down = Window.orderBy(F.desc("_range"))  # over RANGES rows, twice as many at most
    heads = placed.groupBy("_range").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.bitwise_not("_tie").alias("tie"))).alias("_head"))
    heads = heads.select("_range", "_head", F.coalesce(F.lag("_range").over(down), F.min("_range").over(Window.partitionBy())).alias("_above"))
    known = placed.join(F.broadcast(heads), "_range")
    home = F.array(F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest")))
    as_guest = F.array(F.struct(F.col("_above").alias("range"), F.lit(True).alias("guest")))
    first = F.col("doc_id").eqNullSafe(F.col("_head.doc_id")) & (F.bitwise_not("_tie") == F.col("_head.tie"))
    homes = known.withColumn("_home", F.explode(F.when(first, F.concat(home, as_guest)).otherwise(home)))
    order = Window.partitionBy("_home.range").orderBy("_home.guest", F.desc_nulls_last("doc_id"), "_tie")
    out = homes.select(*rows.columns, "_home", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return out.where("not _home.guest").drop("_home")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row of ``docs``, of its edited text, and how alike they are to each other and the next row's.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next
    document by descending doc_id. Reads ``doc_id`` and ``text`` alone; null texts are as empty ones, rows that repeat are
    answered each, an empty table has no rows.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bits = lexicon(own)
    both = with_next(with_fingerprint(own, "text", "fingerprint", bits), "text", "fingerprint", tie=("text",))  # which the fingerprint follows from; the heads of ranges are found without it
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    both = both.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)))
    both = with_fingerprint(both.drop("text", "next_text"), "edited", "edited_fingerprint", bits)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
