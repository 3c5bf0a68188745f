"""Pages by ranges, committed files, routed tables: written to disk and read back."""

import io
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quireline.plans import pages as plans  # noqa: F401
from quireline.plans.catalog import QUERIES
from quireline.sources import filesink, pagefiles, pdf, sinks

IMAGE = "encoding string, width int, height int, channels int, data binary"


def document(rng, n):
    out = []
    for _ in range(n):
        w, h, c = rng.randrange(1, 9), rng.randrange(1, 5), rng.choice((1, 3))
        out.append((w, h, c, rng.randbytes(w * h * c)))
    return out


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(6)
    d = tmp_path_factory.mktemp("scans")
    docs = {f"d{n}.pdf": document(rng, n) for n in (1, 2, 63, 64, 65, 200)}
    docs["odd.pdf"] = [(6, 1, 1, b"endobj"), (9, 1, 1, b"endstream"), (3, 1, 1, b"R\n>")]
    for name, own in docs.items():
        (d / name).write_bytes(pdf.written(own))
    (d / "cut.pdf").write_bytes(pdf.written(docs["d2.pdf"])[:100])
    (d / "none.pdf").write_bytes(pdf.written([]))
    (d / "text.pdf").write_bytes(b"just text")
    return d, docs


def paths(spark, d):
    return spark.createDataFrame([(f"file://{d}/{n}",) for n in sorted(os.listdir(d))], "path string")


@pytest.mark.parametrize("together", [1, 7, 64])
def test_every_page_of_every_range(spark, folder, together):
    d, docs = folder
    got = pagefiles.pages(paths(spark, d), together).collect()
    read = defaultdict(dict)
    for r in got:
        if r.error is None:
            assert r.page_no not in read[os.path.basename(r.path)]
            read[os.path.basename(r.path)][r.page_no] = (r.width, r.height, r.channels, bytes(r.data))
    assert read == {n: dict(enumerate(own, 1)) for n, own in docs.items()}
    assert {os.path.basename(r.path): r.error.split(":")[0] for r in got if r.error} == {"cut.pdf": "RuntimeError", "none.pdf": "RuntimeError", "text.pdf": "ValueError"}


def test_long_documents_are_many_rows_of_work(spark, folder):
    d, _ = folder
    got = pagefiles.ranges(paths(spark, d).where("path like '%d200%'"), 64).collect()
    assert [(r.first, r.last) for r in got] == [(0, 64), (64, 128), (128, 192), (192, 200)]


def test_a_range_reads_its_pages_alone(folder):
    d, docs = folder
    data = (d / "d200.pdf").read_bytes()
    seen = []

    class Seen(io.BytesIO):
        def read(self, n=-1):
            seen.append(n)
            return super().read(n)

    index = pdf.Index(Seen(data), len(data))
    before = sum(seen)
    assert index.page(150) == ("raw", *docs["d200.pdf"][150]) and sum(seen) - before < 1000 < before < len(data)


def test_without_data(spark, folder):
    d, docs = folder
    got = pagefiles.pages(paths(spark, d), data=False).where("error is null").collect()
    assert len(got) == sum(map(len, docs.values())) and all(r.data is None and r.width for r in got)


def test_files_are_written_whole(spark, tmp_path):
    rng = random.Random(3)
    pieces = [(rng.choice("abcdefgh") + ".bin", k, None if k % 9 == 0 else rng.randbytes(rng.randrange(30))) for k in range(300)]
    df = spark.createDataFrame(pieces, "name string, k int, content binary").repartition(6)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "other").write_bytes(b"stays")
    filesink.named_files(df, str(tmp_path / "out"), "k")
    want = defaultdict(bytes)
    for name, _, content in pieces:
        want[name] += content or b""
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {**want, "other": b"stays"}
    filesink.named_files(df.where("name < 'c'"), str(tmp_path / "out"), "k", overwrite=True)
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"a.bin", "b.bin"}


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    """One task fails after others have written, and after it has written half a file itself."""
    bad = F.when(F.col("k") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("content"))
    rows = [(f"{chr(97 + k % 20)}.bin", k, bytes([k])) for k in range(100)]
    df = spark.createDataFrame(rows, "name string, k int, content binary").repartition(6)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "a.bin").write_bytes(b"before")
    dealt = df.repartition("name").sortWithinPartitions("name", "k").withColumn("content", bad).select("name", "content")
    spark.dataSource.register(filesink.NamedFiles)
    with pytest.raises(Exception, match="lost"):
        dealt.write.format("named_files").mode("append").save(str(tmp_path / "out"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {"a.bin": b"before"}


def test_an_attempt_that_was_lost_is_never_seen(tmp_path):
    """Two attempts of a task wrote, the message of one came."""
    import pyarrow as pa

    w = filesink._Writer(str(tmp_path / "out"), "bytes", False)
    batch = pa.RecordBatch.from_pydict({"name": ["a", "a", "b"], "content": [b"1", b"2", b"3"]})
    w.write(iter([batch]))
    w.commit([w.write(iter([batch])), None])
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {"a": b"12", "b": b"3"}


@pytest.mark.parametrize("name", ["", None, "a/b", "..", "_x"])
def test_names_that_are_no_files(spark, tmp_path, name):
    with pytest.raises(Exception, match="name of a file"):
        filesink.named_files(spark.createDataFrame([(name, b"x")], "name string, content binary"), str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out") or not list((tmp_path / "out").iterdir())


def test_documents_and_page_files(spark, folder, tmp_path):
    d, docs = folder
    every = pagefiles.pages(paths(spark, d))
    sinks.document_files(every, str(tmp_path / "docs"))
    sinks.page_files(every, str(tmp_path / "pages"))
    whole = pagefiles.pages(paths(spark, tmp_path / "docs")).collect()
    assert Counter((os.path.basename(r.path), r.page_no, bytes(r.data)) for r in whole) == Counter((n, k, p[3]) for n, own in docs.items() for k, p in enumerate(own, 1))
    single = {os.path.basename(r.path): bytes(r.data) for r in pagefiles.pages(paths(spark, tmp_path / "pages")).collect()}
    assert single == {f"{n[:-4]}_page_{k}.pdf": p[3] for n, own in docs.items() for k, p in enumerate(own, 1)}


def test_texts_in_one_folder(spark, tmp_path):
    df = spark.createDataFrame([("a", "first"), ("b", None), ("c", "é\n")], "stem string, text string")
    sinks.text_files(df, str(tmp_path / "t"), "_model")
    assert {p.name: p.read_text() for p in (tmp_path / "t").iterdir()} == {"a_model.txt": "first", "b_model.txt": "", "c_model.txt": "é\n"}


def test_routing_is_one_evaluation(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = spark.createDataFrame([(i, "abc"[i % 3], None) for i in range(90)], "i int, target string, note string").repartition(4)
    got = sinks.routed(rows.mapInPandas(once, rows.schema), str(tmp_path / "r"), ("a", "b", "c", "d"))
    assert got == {"a": 30, "b": 30, "c": 30, "d": 0} and seen.value == 90
    for t, n in got.items():
        assert sorted(r.i for r in sinks.target(spark, str(tmp_path / "r"), t).collect()) == [i for i in range(90) if "abcd".index(t) == i % 3] and n <= 30


def test_routing_fails_as_a_whole(spark, tmp_path):
    rows = spark.createDataFrame([(i, "a") for i in range(50)], "i int, target string")
    sinks.routed(rows, str(tmp_path / "r"), ("a", "b"))
    for wrong in ("z", None):
        with pytest.raises(Exception, match="no such target"):
            sinks.routed(rows.withColumn("target", F.when(F.col("i") == 49, F.lit(wrong)).otherwise("b")), str(tmp_path / "r"), ("a", "b"))
    assert sinks.manifest(str(tmp_path / "r"))["counts"] == {"a": 50, "b": 0} and sinks.target(spark, str(tmp_path / "r"), "a").count() == 50


def test_observed(spark, tmp_path):
    said = []
    rows, tell = sinks.observed(spark.range(100), said.append, n=F.count("*"), even=F.count_if(F.col("id") % 2 == 0))
    rows.write.parquet(str(tmp_path / "o"))
    tell()
    assert said == [{"n": 100, "even": 50}]


def conversations(spark, sf):
    own = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        own[r.conv_id].append((r.turn, ((r.text or "") + "\n").encode()))
    return {c: [d for _, d in sorted(rows)] for c, rows in own.items()}


def test_queries_over_files(spark, sf):
    import hashlib

    md5 = lambda b: hashlib.md5(b).hexdigest()
    want = conversations(spark, sf)
    got = QUERIES["pages_through_files"](spark, sf).collect()
    assert Counter(map(tuple, got)) == Counter((f"{c}.pdf", k, len(d), md5(d), None) for c, pages in want.items() for k, d in enumerate(pages, 1))
    got = QUERIES["pages_split_to_files"](spark, sf).collect()
    assert Counter(map(tuple, got)) == Counter((f"{c}_page_{k}.pdf", 1, len(d), md5(d), None) for c, pages in want.items() for k, d in enumerate(pages, 1))
    counts = {r.category: r.n for r in QUERIES["category_counts"](spark, sf).collect()}
    kept = {r.category: (r.n, r.n_read) for r in QUERIES["routed_records"](spark, sf).collect()}
    assert set(kept) == set(counts) and all(a == b for a, b in kept.values()) and sum(a for a, _ in kept.values()) == sum(counts.values())


def test_rows_come_in_bounded_batches():
    row = lambda k, data: (f"{k}", k, "raw", 1, 1, 1, data, None)
    small = list(pagefiles.batched((row(k, b"x") for k in range(600)), pagefiles._PAGE))
    assert [b.num_rows for b in small] == [256, 256, 88] and [r["page_no"] for b in small for r in b.to_pylist()] == list(range(600))
    large = list(pagefiles.batched((row(k, bytes(3 << 20)) for k in range(5)), pagefiles._PAGE))
    assert [b.num_rows for b in large] == [2, 2, 1] and not list(pagefiles.batched(iter(()), pagefiles._PAGE))


def test_pages_are_read_once(spark, sf, monkeypatch):
    from quireline.plans import catalog
    from quireline.plans import pages as plans

    read, written = [], plans.written
    monkeypatch.setattr(plans, "written", lambda df: read.append(df.columns) or written(df))
    split = plans.pages_split_to_files(catalog.Tables(spark, sf))
    assert len(read) == 1 and "data" in read[0] and split.where("error is not null").count() == 0
    assert split.count() == spark.read.parquet(f"{sf}/conversations.parquet").count()
