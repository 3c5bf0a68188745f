"""Cascading erasure against lists of rows, and its parts one by one."""

import hashlib
import math
import os
import random
import shutil
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quireline.llm import erasure, queries
from quireline.llm.common import opened

NAMES = [t.name for t in erasure.SHOP]


def crc(x):
    return zlib.crc32(("" if x is None else str(x)).encode())


def key(row):
    return [(v is not None, v.encode() if isinstance(v, str) else 0 if v is None else v) for v in row]


def plainly(tables: dict[str, tuple[list[str], list[tuple]]]):
    """What the query returns, less paths, from lists of rows, and the rows of each final file."""
    at = {n: {c: k for k, c in enumerate(cols)} for n, (cols, _) in tables.items()}
    get = lambda n, row, c: row[at[n][c]]
    owner = {}
    for r in tables["sales"][1]:
        s, c = get("sales", r, "sale_id"), get("sales", r, "client_id")
        if s is not None:
            owner[s] = min((x for x in (owner.get(s), c) if x is not None), default=None)
    clicks = Counter(get("clicks", r, "client_id") for r in tables["clicks"][1])
    pairs = {(get("clients", r, "master_id"), get("clients", r, "client_id")) for r in tables["clients"][1] if get("clients", r, "master_id") is not None}
    n = defaultdict(int)
    for m, c in pairs:
        n[m] += clicks[c] if c is not None else 0
    masters = {m for m in n if crc(m) % 200 == 0} | set(sorted(n, key=lambda m: (-n[m], m))[:1])
    clients = {get("clients", r, "client_id") for r in tables["clients"][1] if get("clients", r, "master_id") in masters} - {None}
    sales = {get("sales", r, "sale_id") for r in tables["sales"][1] if get("sales", r, "client_id") in clients} - {None}
    gone = {"clients": ("master_id", masters), "clicks": ("client_id", clients), "sales": ("client_id", clients), "sale_lines": ("sale_id", sales)}
    money = {"clients": "balance", "clicks": "value", "sales": "total", "sale_lines": "amount"}
    out, held = {}, {}
    for name, (cols, rows) in tables.items():
        link, victims = gone[name]
        first = lambda r: crc(owner.get(get(name, r, "sale_id")) if name == "sale_lines" else get(name, r, "client_id"))  # noqa: B023, E731
        rows = sorted(rows, key=lambda r: (first(r), key(r)))
        size = 1 + len(rows) // 250
        for k in range(0, len(rows), size):
            own = rows[k : k + size]
            left = [r for r in own if get(name, r, link) not in victims]
            if left:
                cents = sum(math.floor(100 * x + 0.5) for x in (get(name, r, money[name]) for r in left) if x is not None)
                sha = hashlib.sha256(",".join("" if r[0] is None else str(r[0]) for r in left).encode()).hexdigest()
                out[name, k // size] = (len(left), len(own) - len(left), cents, len(left) < len(own), sha, ",".join(cols))
                held[name, k // size] = left
    return out, held


def same(df, frames):
    want, held = plainly({n: (f.columns, [tuple(r) for r in f.collect()]) for n, f in frames.items()})
    got = df.collect()
    assert {(r.table_name, r.file_no): (r.n_rows, r.n_erased, r.cents, r.rewritten, r.ids_sha256, r["columns"]) for r in got} == want
    for r in got:
        rows = [tuple(x.values()) for x in pq.read_table(opened(r.path)[1]).to_pylist()]
        assert rows == held[r.table_name, r.file_no], r.path
    folders = {os.path.dirname(os.path.dirname(opened(r.path)[1])) for r in got}
    for folder in folders:
        assert {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names} == {opened(r.path)[1] for r in got}
        assert not os.path.exists(f"{folder}-work")
    return got


def test_query(spark, sf):
    frames = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in NAMES}
    got = same(queries.op11_cascading_erasure(spark, sf), frames)
    for r in got[:40]:  # statistics are of the rows that are left
        at = opened(r.path)[1]
        group, first = pq.ParquetFile(at).metadata.row_group(0), pq.read_table(at).column(0)
        assert (group.column(0).statistics.min, group.column(0).statistics.max) == (min(first.to_pylist()), max(first.to_pylist()))
    assert any(r.rewritten for r in got) and not all(r.rewritten for r in got)


def shop(spark, clients, clicks, sales, lines):
    make = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)
    return {
        "clients": make(clients, "client_id long, master_id long, name string, balance double"),
        "clicks": make(clicks, "click_id long, ts timestamp_ntz, client_id long, value double, props string"),
        "sales": make(sales, "sale_id long, client_id long, total double"),
        "sale_lines": make(lines, "sale_id long, line_no int, amount double, _quireline_note string"),
    }


def test_nulls_ties_and_hot_keys(spark):
    rng = random.Random(4)
    of = lambda n: rng.choice([None, 7, 7, 7, *range(n)])
    clients = [(i if i % 40 else None, of(60), rng.choice([None, "n", "é", ""]), rng.choice([None, -1.005, 2.675, 1e6])) for i in range(300)] + [(7, 7, "again", 0.1), (7, 9, "two masters", 0.1)] * 2
    clicks = [(rng.choice([None, i]), rng.choice([None, datetime(2024, 1, 1, 0, 0, i % 60)]), of(300), rng.random(), rng.choice([None, "{}", "x" * 30])) for i in range(900)] + [(1, None, 7, None, None)] * 200
    sales = [(rng.choice([None, i, i, i, 11]), of(300), rng.random() * 50) for i in range(400)]
    lines = [(of(500), rng.choice([None, 1, 2]), rng.random(), None) for _ in range(700)] + [(11, 1, 0.5, "hot")] * 400
    frames = shop(spark, clients, clicks, sales, lines)
    same(erasure.query(*frames.values()), frames)


def test_everything_goes_and_nothing_does(spark):
    frames = shop(spark, [(1, 5, "a", 1.0), (2, None, "b", 2.0)], [(1, None, 1, 1.0, None)] * 600, [(1, 1, 1.0)], [(1, 1, 1.0, None), (2, 1, 2.0, None)])
    got = same(erasure.query(*frames.values()), frames)
    assert {r.table_name for r in got} == {"clients", "sale_lines"}
    frames = shop(spark, [(1, None, "a", 1.0)], [(1, None, 1, 1.0, None)], [], [])
    assert [r.rewritten for r in same(erasure.query(*frames.values()), frames)] == [False, False]


def test_empty_tables(spark):
    frames = shop(spark, [], [], [], [])
    assert erasure.query(*frames.values()).collect() == []


def test_filters_have_no_false_negatives(spark):
    rng = random.Random(1)
    for n in (1, 2, 1000, 20000):
        keys = pa.array([rng.getrandbits(40) for _ in range(n)])
        hashes = erasure._hashes(keys)
        made = erasure.bloom(np.unique(hashes))
        assert erasure.may_hold(made, hashes).all()
        assert erasure.may_hold(made, erasure._hashes(pa.array(range(1 << 41, (1 << 41) + 50_000)))).sum() <= 3
    assert not erasure.may_hold(erasure.bloom(erasure._hashes(pa.array([1]))), np.array([], np.uint64)).any()


def test_hashes_are_sparks(spark):
    longs, texts = [0, 1, -1, 2**62, -(2**63)], ["", "a", "é語", "x" * 100]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in longs], "k long").select(F.xxhash64("k")).collect()]
    assert erasure._hashes(pa.array(longs)).view(np.int64).tolist() == got
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "k string").select(F.xxhash64("k")).collect()]
    assert erasure._hashes(pa.array(texts)).view(np.int64).tolist() == got


@pytest.mark.parametrize("together", [(4, 1 << 18), (512, 5)])
def test_blocks_of_files_and_keys(spark, monkeypatch, together):
    """With few files or keys a task the same files are found."""
    monkeypatch.setattr(erasure, "FILES_TOGETHER", together[0])
    monkeypatch.setattr(erasure, "KEYS_TOGETHER", together[1])
    rows = [("t", n, 1, 0, erasure.bloom(erasure._hashes(pa.array([n, n + 100])))) for n in range(30)] + [("t", 30, 1, 0, None)]
    filters = spark.createDataFrame(rows, "table_name string, file_no long, buckets int, bucket int, bits binary")
    keys = spark.createDataFrame([(3,), (104,), (29,), (500,)], "key long")
    assert sorted(r.file_no for r in erasure.shortlist(filters, keys, ["t"]).collect()) == [3, 4, 29]


def test_rewriting_again_changes_nothing(spark, tmp_path):
    """As when a task runs again after its file was moved, or emptied."""
    folder = str(tmp_path / "a")
    for d in ("a/t", "a-work"):
        os.makedirs(tmp_path / d)
    pq.write_table(pa.table({"k": [1, 2, 2, None], "v": ["a", "b", "c", "d"]}), f"{folder}/t/000000.parquet")
    pq.write_table(pa.table({"k": [2, 2], "v": ["a", "b"]}), f"{folder}/t/000001.parquet")
    files = spark.createDataFrame([("t", 0, "k", [2]), ("t", 1, "k", [2])], "table_name string, file_no long, link string, keys array<long>")
    for _ in range(2):
        assert sorted((r.file_no, r.rows) for r in erasure.rewrite(files, folder).collect()) == [(0, 2), (1, 0)]
        assert pq.read_table(f"{folder}/t/000000.parquet").to_pylist() == [{"k": 1, "v": "a"}, {"k": None, "v": "d"}] and not os.path.exists(f"{folder}/t/000001.parquet")
    shutil.rmtree(folder)


def test_other_kinds_of_keys(spark, tmp_path):
    """Texts link tables as numbers do; files are cut as asked."""
    people = spark.createDataFrame([(f"p{i}", f"g{i % 5}", float(i)) for i in range(50)], "id string, grp string, v double")
    notes = spark.createDataFrame([(i, f"p{i % 60}", 1.0) for i in range(300)], "n long, person string, v double")
    cascade = [erasure.Linked("people", "grp", "id", None, "v", "string"), erasure.Linked("notes", "person", None, "people", "v")]
    keys = spark.createDataFrame([("g2",)], "key string")
    got = erasure.erase({"people": (people, F.col("id"), people.columns), "notes": (notes, F.col("n"), notes.columns)}, cascade, keys, str(tmp_path / "a"), files=10)
    n = {t: (sum(r.n_rows for r in rows), sum(r.n_erased for r in rows), len(rows)) for t in ("people", "notes") for rows in [[r for r in got.collect() if r.table_name == t]]}
    assert n == {"people": (40, 10, 9), "notes": (250, 50, 10)}
