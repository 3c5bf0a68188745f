"""Exact copies of lines go, however short the line is."""

from quireline.llm import linededup

TEXTS = [
    "All rights reserved.\n\n漢字仮名交じり文\na\tb\tc",
    "new\n\nAll rights reserved.\n \t\n漢字仮名交じり文",
    "  new  \nhttps://example.org/a/long/path?with=query\na\tb\tc",
    "https://example.org/a/long/path?with=query\n　\n1",
    None,
    "1",
]
KEPT = [TEXTS[0], "new\n\n \t", "https://example.org/a/long/path?with=query", "　\n1", None, ""]


def test_exact_copies_of_short_lines_go(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup(docs).collect()}
    assert got == {0: (KEPT[0], 0), 1: (KEPT[1], 2), 2: (KEPT[2], 2), 3: (KEPT[3], 1), 4: (None, 0), 5: ("", 1)}


def test_short_lines_are_only_matched_exactly(spark):
    docs = spark.createDataFrame([(0, "one two three four"), (1, "one two three five"), (2, "one  two three four")], "doc_id long, text string")
    assert [r.n_dropped for r in linededup.dedup(docs).orderBy("doc_id").collect()] == [0, 0, 0]
