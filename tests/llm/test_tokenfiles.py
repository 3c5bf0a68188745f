"""Files of token ids: exact round trips, the library's own ids, damaged files, single documents."""

import hashlib
import random
import re
import shutil
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quireline.llm import queries, tokenfiles, wordids


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(wordids.public_vocabulary())
    t.encode_special_tokens = True
    return t


def texts():
    rng = random.Random(9)
    mixed = ["aB'sS \n\tdDvVe.,!9é'", "It's WE'LL don't '' 's. ", "ПриветЁё ", "語字 かな ", "é é   İIı", "<|endoftext|> ", "\U0001f600\x00\x85"]
    return [None, "", " ", "\n\n", "<|startoftext|>", "x" * 100_000, "z" * 70 + " " + "z" * 70, "word " * 30_000] + ["".join(rng.choices(rng.choice(mixed), k=rng.choice((1, 2, 9, 80)))) for _ in range(400)]


def test_ids_are_the_librarys(library):
    own = wordids.WordIds(wordids.public_vocabulary())
    plain = lambda t: library.encode(t or "", add_special_tokens=False).ids
    for _ in range(2):  # with empty and with filled tables
        assert [np.frombuffer(b, "<u2").tolist() for b in own.packed(pa.array(texts()))] == [plain(t) for t in texts()]
    assert all(len(w) <= wordids.CACHE_LENGTH for w in own.parts)


def test_every_character_of_the_quick_path(library):
    own = wordids.WordIds(wordids.public_vocabulary())
    quick = [c for c in map(chr, range(0x2200)) if not re.search(wordids.OTHER, c)]
    assert len(quick) > 500
    for c in (f"a{c}b {c}{c} 'S{c}" for c in quick):
        assert np.frombuffer(own.packed(pa.array([c]))[0], "<u2").tolist() == library.encode(c, add_special_tokens=False).ids, c


def test_tables_start_anew(monkeypatch, library):
    monkeypatch.setattr(wordids, "CACHE_PARTS", 2)
    own = wordids.WordIds(wordids.public_vocabulary())
    for t in texts()[8:60]:
        assert np.frombuffer(own.packed(pa.array([t], pa.string()))[0], "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("sampled", [2000, 3])  # with a dictionary, and with too few texts for one
def test_round_trip(spark, tmp_path, library, monkeypatch, sampled):
    monkeypatch.setattr(tokenfiles, "SAMPLED", sampled)
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())] + [(7, "same id"), (7, "another text"), (7, "another text"), (-5, "below nought")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = tokenfiles.write(df, str(tmp_path / "a")).collect()
    own = {(i, t): (library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows}
    got = tokenfiles.read(spark, str(tmp_path / "a")).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(own[i, t])) for i, t in rows)
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or r.doc_id >= last)
        at, last = at + len(r.ids), r.doc_id
    assert at == sum(f.n_ids for f in files) and sum(f.n_docs for f in files) == len(rows)
    sums = {(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfiles.digest(spark, str(tmp_path / "a")).collect()}
    assert sums == {(r.start, r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}


def test_single_documents(spark, tmp_path):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)] + [(5, "five again"), (None, "none")]
    tokenfiles.write(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "a"))
    every = Counter((r.doc_id, tuple(r.ids)) for r in tokenfiles.read(spark, str(tmp_path / "a")).collect())
    wanted = spark.createDataFrame([(5,), (5,), (0,), (299,), (300,), (-1,), (None,)], "doc_id long")
    got = Counter((r.doc_id, tuple(r.ids)) for r in tokenfiles.lookup(wanted, str(tmp_path / "a")).collect())
    assert got == Counter({k: n for k, n in every.items() if k[0] in (0, 5, 299)}) and sum(got.values()) == 4


def test_files_and_dictionary_belong_together(spark, tmp_path):
    df = spark.createDataFrame([(i, f"some words of text {i} " * 20) for i in range(400)], "doc_id long, text string")
    tokenfiles.write(df, str(tmp_path / "a"))
    dictionary = (tmp_path / "a" / "dictionary").read_bytes()
    assert dictionary
    (tmp_path / "a" / "files" / "orphan.ids").write_bytes(b"of a lost attempt")
    assert tokenfiles.read(spark, str(tmp_path / "a")).count() == 400  # the manifest alone says what counts
    f = next(p for p in (tmp_path / "a" / "files").iterdir() if p.name != "orphan.ids")
    assert f.read_bytes()[5:37] == hashlib.sha256(dictionary).digest()
    shutil.copytree(tmp_path / "a", tmp_path / "b")
    (tmp_path / "b" / "dictionary").write_bytes(dictionary[:-1] + b"x")
    with pytest.raises(Exception, match="another dictionary"):
        tokenfiles.read(spark, str(tmp_path / "b")).collect()


def test_half_a_file_is_an_error(spark, tmp_path):
    tokenfiles.write(spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string"), str(tmp_path / "a"))
    for f in (tmp_path / "a" / "files").iterdir():
        f.write_bytes(f.read_bytes()[:-3])
    with pytest.raises(Exception, match="whole file"):
        tokenfiles.read(spark, str(tmp_path / "a")).collect()


def test_empty_tables_and_other_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, ids string, start int")
    tokenfiles.write(df, str(tmp_path / "a"))
    tokenfiles.write(df.limit(0), str(tmp_path / "b"))
    assert tokenfiles.read(spark, str(tmp_path / "a")).count() == 1 and tokenfiles.read(spark, str(tmp_path / "b")).count() == 0
    assert tokenfiles.lookup(df, str(tmp_path / "b")).count() == 0


def test_query(spark, sf, library):
    at = 0
    got = {r.doc_id: r for r in queries.op13_token_files(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [1]
        assert tuple(got.pop(d.doc_id)) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got
