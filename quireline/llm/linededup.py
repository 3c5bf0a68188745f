"""Line dedup by a deletion-neighbourhood join, in DataFrame operations alone.

Of lines with the same words the earliest stays, whatever their number of words; blank lines always stay. Of distinct lines
of ``LEAST_WORDS_NEAR`` words or more that are one word apart (a word replaced, put in or left out)
the earlier one stays as well: each line emits a key for every word left out, made of the words before and those after
it, and a key for every place where a word could have been put in. Two lines share a key if and only if they are at most
one word apart, so a key's earliest line decides for the others, and no pairs within a key are listed. A line goes if an earlier one is one
word apart, whether or not that one stays itself: of a chain of lines, each one word from the next, the first stays.

Only lines that share all but a third with another one can be that close, so only those emit keys: the word that two lines
differ in lies within one third, and the words before and behind that third are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireline.functions import text as T
from quireline.llm.common import durable, small

#: Lines of fewer words are removed only if all their words are the same.
LEAST_WORDS_NEAR = 10

#: Parts of a line of which all but one must be shared.
PARTS = 3

_AT = ["doc_id", "row", "line_no"]


def _words(line: Column) -> Column:
    return F.split(F.trim(line), " ")


def _blank(line: Column) -> Column:
    """Of white space alone; such lines separate paragraphs. Lines that begin with a visible ASCII character need no pattern."""
    return ~(F.ascii(line).between(33, 126) | T.not_blank(line))


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells rows of one id apart, text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _shares(words: Column, n: Column) -> list[Column]:
    """Hashes of the words before and behind each third of the line, and of a line one word shorter, so that a line meets
    those of as many words and those of one word more or less."""
    out = []
    for size in (n, n - 1):
        cut = [F.floor(size * q / PARTS).cast("int") for q in range(PARTS + 1)]
        for q in range(PARTS):
            behind = size - cut[q + 1]
            out.append(F.xxhash64(size, F.lit(q), F.slice(words, F.lit(1), cut[q]), F.slice(words, n - behind + 1, behind)))
    return out


def _firsts(docs: DataFrame) -> DataFrame:
    """The earliest place of each distinct line with the hashes of its halves, by the line's own two hashes."""
    lines = _rows(docs).select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.where(~_blank(F.col("line"))).withColumn("words", _words(F.col("line"))).withColumn("n", F.size("words"))
    near = F.col("n") >= LEAST_WORDS_NEAR
    shares = [F.when(near, h).alias(f"share{k}") for k, h in enumerate(_shares(F.col("words"), F.col("n")))]
    own = lines.select(*_AT, F.xxhash64(F.trim("line")).alias("h"), F.hash(F.trim("line")).alias("g"), *shares)
    first = own.groupBy("h", "g").agg(F.min(F.struct(*_AT)).alias("first"), *(F.min(f"share{k}").alias(f"share{k}") for k in range(2 * PARTS)))
    return first.select("h", "first.*", *(f"share{k}" for k in range(2 * PARTS)))


#: Words up to which a line's running sums are appended one by one; those of longer lines are made of chunks of so many.
_CHUNK = 64
_SHORT = 256


def _sided(words: Column) -> Column:
    """Hash of the first k words at k, from none to all: the sum of hashes of word and place.

    Of a long line sums within chunks and over chunks are added, so the work is in proportion to its words, however many.
    """
    each = F.transform(words, lambda w, k: F.xxhash64(w, k).bitwiseAND((1 << 40) - 1))
    part = lambda g, at, n: F.aggregate(F.slice(g, at, n), F.lit(0).cast("long"), lambda a, x: a + x)
    chunk = F.lit(_CHUNK)

    def appended(g: Column) -> Column:
        return F.aggregate(g, F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

    def chunked(g: Column) -> Column:
        ends = F.transform(F.sequence(F.lit(0), F.floor(F.size(g) / chunk).cast("int")), lambda c: part(g, c * chunk + 1, chunk))
        starts = appended(ends)
        # transform over arrays of one entry: what is inside is computed once
        return F.transform(F.array(starts), lambda s: F.transform(F.sequence(F.lit(0), F.size(g)), lambda k: F.get(s, F.floor(k / chunk).cast("int")) + part(g, F.floor(k / chunk).cast("int") * chunk + 1, k % chunk)))[0]

    return F.transform(F.array(each), lambda g: F.when(F.size(g) <= _SHORT, appended(g)).otherwise(chunked(g)))[0]


def _one_apart(a: Column, b: Column) -> Column:
    """At most one word apart: what the two have in common before and behind covers all but one word."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        same = F.zip_with(F.slice(x, F.lit(1), shorter), F.slice(y, F.lit(1), shorter), lambda v, w: v == w)
        first_not = F.array_position(same, F.lit(False)).cast("int")
        return F.when(first_not == 0, shorter).otherwise(first_not - 1)

    return (longer - shorter <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Places of the distinct lines that have an earlier distinct line one word apart."""
    shares = firsts.select("h", F.explode(F.array_compact(F.array(*(f"share{k}" for k in range(2 * PARTS))))).alias("share"))
    shared = durable(shares.groupBy("share").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count("*").alias("n")).where("n > 1"))
    two = shared.select(F.explode(F.array("lo", "hi")).alias("h"))
    more = shares.join(small(shared.where("n > 2").select("share")), "share", "left_semi").select("h")  # of larger groups, those between the two
    may = small(two.union(more).distinct())
    places = small(firsts.join(may, "h", "left_semi").groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("line_nos")), F.size("line_nos"))
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.row") == F.col("p.row"))
    texts = _rows(docs).alias("d").join(places.alias("p"), same)
    lines = texts.select("d.doc_id", "d.row", F.explode("line_nos").alias("line_no"), F.split("text", "\n").alias("all"))
    lines = lines.select(*_AT, _words(F.element_at("all", F.col("line_no") + 1)).alias("words")).dropDuplicates(_AT)
    lines = durable(lines.withColumn("line", F.monotonically_increasing_id()))

    sided = lines.select("line", _sided(F.col("words")).alias("before"), F.reverse(_sided(F.reverse("words"))).alias("after"))
    # before[k] hashes the first k words, after[k] those behind the first k
    left_out = F.expr("transform(sequence(1, size(before) - 1), i -> xxhash64(before[i - 1], after[i]))")
    put_in = F.expr("transform(sequence(0, size(before) - 1), i -> xxhash64(before[i], after[i]))")
    keyed = sided.select("line", F.explode(F.concat(left_out, put_in)).alias("key"))
    met = small(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    members = durable(keyed.join(met, "key").join(lines.select("line", F.struct(*_AT).alias("at"), "words"), "line"))
    least = members.groupBy("key").agg(F.min(F.struct("at", "words")).alias("least"))
    near = members.join(durable(least), "key").where(F.col("at") > F.col("least.at"))
    return near.where(_one_apart(F.col("words"), F.col("least.words"))).select("at.*").distinct()


def cleaned(docs: DataFrame, near: bool = True, counts: tuple[str, str] = ("_n_lines", "_n_dropped")) -> DataFrame:
    """``docs`` with the ``text`` of the lines that stay and, by the names ``counts``, how many lines there were and how many went;
    every other column and row is kept.

    Lines end with a line feed and are compared by their words, that is without the spaces around them; earlier is by
    doc_id, then by place. Blank lines always stay. A null text stays null
    and has no lines. Rows that repeat both id and text count as one and are answered alike.
    """
    firsts = durable(_firsts(docs))
    marks = firsts.select(*_AT, F.lit(True).alias("first"))
    if near:
        marks = marks.unionByName(near_lines(docs, firsts).withColumn("first", F.lit(False)))
    marks = marks.groupBy("doc_id", "row").agg(F.collect_list(F.when(F.col("first"), F.col("line_no"))).alias("firsts"), F.collect_list(F.when(~F.col("first"), F.col("line_no"))).alias("nears"))
    marks = marks.select(F.col("doc_id").alias("_quireline_id"), F.col("row").alias("_quireline_row"), F.col("firsts").alias("_quireline_firsts"), F.col("nears").alias("_quireline_nears"))
    text = F.col("text").cast("string")
    own = docs.join(marks, docs["doc_id"].cast("long").eqNullSafe(F.col("_quireline_id")) & F.xxhash64(text).eqNullSafe(F.col("_quireline_row")), "left")
    none = F.array().cast("array<int>")
    own = own.withColumn("_quireline_lines", F.split(text, "\n"))
    blank = F.filter(F.transform("_quireline_lines", lambda line, i: F.when(_blank(line), i)), lambda i: i.isNotNull())
    own = own.withColumn("_quireline_stay", F.array_sort(F.array_except(F.concat(blank, F.coalesce("_quireline_firsts", none)), F.coalesce("_quireline_nears", none))))
    there = text.isNotNull()
    kept = [F.array_join(F.expr("transform(_quireline_stay, i -> _quireline_lines[i])"), "\n").alias("text") if c == "text" else docs[c] for c in docs.columns]
    n_dropped = F.when(there, F.size("_quireline_lines") - F.size("_quireline_stay")).otherwise(0).cast("long")
    return own.select(*kept, F.when(there, F.size("_quireline_lines")).otherwise(0).cast("long").alias(counts[0]), n_dropped.alias(counts[1]))


def dedup(docs: DataFrame, near: bool = True) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the ``text`` of the lines that stay, for each row; see ``cleaned``."""
    return cleaned(docs.select("doc_id", "text"), near).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")
