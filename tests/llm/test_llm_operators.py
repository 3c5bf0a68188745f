"""Operators on small fixtures against brute force, with the odd cases of each."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireline.llm import decontamination, fingerprints, htmltext, linededup, neardup, packing, quality, rollups, secrets, subwords, tokenizing, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, score double, line string, key long, node long, h long, row long"
WORDS = "amber basin cedar delta ember fjord grove haven islet jetty knoll ledge marsh nadir ocean plain quarry ridge shoal tarn upland vale wharf yonder".split()


def docs_of(spark, texts, ids=None):
    """Documents with more columns, whose names operators use inside."""
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 9.0, "y", 1, 2, 3, 4) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


ODD = [None, "", " \n\t ", "one", "one two", "a\x00b", "ß😀 é x", "word " * 40_000]


# --- token ids and packing


def test_ids_are_those_of_the_public_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    e = tokenizing.encoder(*tokenizing.public_vocabulary())
    odd = ["a  b\n\n c", "it's I'll 's x'S we've", " 12 ab3 ½ ² x", "日本 語", "\x1c a b\x0b", "<|endoftext|> a", "\t\n b ", "é’s — “q” …", "x y z", "Привет, мир!", "_a_ __b a_b", "ǅungla ʼn", "'re 'RE", "$5.00!!  ", "​zero", "a\r\nb", "ªº µ", "٣ ५"]
    rng = random.Random(3)
    odd += ["".join(rng.choice("ab \n'0.é½日_-sStT") for _ in range(60)) for _ in range(200)]
    for text in [*odd, "word " * 5000]:
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(e.packed(text), "<u4").tolist() == want, text
        assert tokenizing.counts(text, [e]) == [len(want)]


def test_best_two_fit_swaps_the_smallest_for_two():
    plan = packing.best_two_fit({60: 1, 30: 1, 25: 1, 14: 1}, 100)  # 60 + 30 leaves 10; 25 + 14 fill the 40
    assert plan[0] == ((60, 25, 14), 1) and plan[1] == ((30,), 1)


def test_bins_hold_all_pieces_once():
    rng = random.Random(1)
    for draw in (lambda: rng.randrange(1, 65), lambda: rng.randrange(1, 31), lambda: max(1, min(64, int(rng.lognormvariate(2.5, 1)))), lambda: 1):
        counts = Counter(draw() for _ in range(5000))
        plan = packing.best_two_fit(dict(counts), 64)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 64
            for n in lengths:
                used[n] += times
        assert used == counts
        least = -(-sum(k * v for k, v in counts.items()) // 64)
        assert least <= sum(t for _, t in plan) <= 1.01 * least + 1
    assert packing.best_two_fit({}, 64) == []


def test_packing_places_every_piece(spark):
    rng = random.Random(2)
    texts = [*ODD, *(sentence(rng, rng.randrange(1, 80)) for _ in range(60)), "same text here", "same text here"]
    docs = docs_of(spark, texts).union(docs_of(spark, ["same text here"], [len(texts) - 1]))
    got = packing.pack(packing.token_pieces(docs, 64), 64).toPandas()
    e = tokenizing.encoder(*tokenizing.public_vocabulary())
    want = Counter()
    for i, text in [*enumerate(texts), (len(texts) - 1, "same text here")]:
        ids = e.packed(text) + bytes(4)
        assert len(ids) // 4 == sum(n for _, n in packing.cut(len(ids) // 4, 64))
        for k, (start, n) in enumerate(packing.cut(len(ids) // 4, 64)):
            want[i, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])] += 1
    assert Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 64
    assert packing.pack(packing.token_pieces(docs_of(spark, []))).count() == 0


# --- decontamination


def brute_hits(text, items):
    w = decontamination.words(text)
    hit, ids = set(), set()
    for item, own in items:
        v = decontamination.words(own)
        if not v:
            continue
        size = min(10, len(v))
        wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wins:
                hit.update(range(i, i + size))
                ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(4)
    items = [(k, sentence(rng, n)) for k, n in enumerate((3, 9, 10, 11, 25, 40))] + [(6, None), (7, "..."), (2, sentence(rng, 12))]
    texts = [*ODD, items[0][1].upper() + "!", f"x {items[4][1]} y", items[5][1].replace(" ", "--"), f"{items[0][1]}{items[1][1]}", sentence(rng, 50), items[4][1][:60]]
    bench = spark.createDataFrame([(a, b, "z") for a, b in items], "item_id long, text string, doc_id string")
    got = decontamination.digest(decontamination.find(docs_of(spark, texts), bench)).collect()
    for r in got:
        n, hit, ids = brute_hits(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert sum(r.contaminated for r in got) >= 3
    spans = {r.doc_id: r.spans for r in decontamination.find(docs_of(spark, texts), bench).where("size(spans) > 0").collect()}
    at = len(ODD) + 1
    assert texts[at][spans[at][0].start : spans[at][0].end] == items[4][1]
    assert decontamination.digest(decontamination.find(docs_of(spark, texts), bench.limit(0))).where("contaminated or n_words is null").count() == 0
    assert decontamination.find(docs_of(spark, []), bench).count() == 0


def test_a_benchmark_beyond_one_automaton(spark, monkeypatch):
    rng = random.Random(5)
    items = [(k, sentence(rng, 20)) for k in range(12)]
    texts = [f"{items[k][1]} {sentence(rng, 5)} {items[k + 1][1]}" for k in range(0, 12, 2)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = decontamination.digest(decontamination.find(docs_of(spark, texts), bench)).toPandas()
    kept = {r.doc_id for r in decontamination.clean(docs_of(spark, [*texts, "clean"]), bench).collect()}
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", 500)
    assert {r.doc_id for r in decontamination.clean(docs_of(spark, [*texts, "clean"]), bench).collect()} == kept == {6}
    nameless = bench.select(F.lit(None).cast("long").alias("item_id"), "text")
    assert decontamination.digest(decontamination.find(docs_of(spark, texts), nameless)).where("contaminated and n_items = 0").count() == 6
    parts = decontamination.digest(decontamination.find(docs_of(spark, texts), bench)).toPandas()
    assert whole.sort_values("doc_id").values.tolist() == parts.sort_values("doc_id").values.tolist() and (whole.n_items == 2).all()


# --- line dedup


def brute_lines(rows):
    """rows: (id, text) in order of ids, all different."""
    first = {}
    split = lambda s: s.strip(" ").split(" ")
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            if line.strip():
                first.setdefault(tuple(split(line)), (i, k))

    def apart(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        p = 0
        while p < min(len(a), len(b)) and a[p] == b[p]:
            p += 1
        s = 0
        while s < min(len(a), len(b)) and a[-1 - s] == b[-1 - s]:
            s += 1
        return p + s >= max(len(a), len(b)) - 1

    long = sorted((at, w) for w, at in first.items() if len(w) >= 10)
    gone = {at for (at, w) in long if any(at > at2 and apart(w, w2) for at2, w2 in long)}
    kept = set(first.values()) - gone
    return {i: None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if not line.strip() or (i, k) in kept) for i, t in rows}


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(6)
    base = [sentence(rng, n) for n in (4, 5, 9, 10, 11, 12, 13, 20, 21, 33)]
    texts = [None, "", "\n", " \n\t", "one two", "one two"]
    for _ in range(40):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(base).split(" ")
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(w))
                how = rng.randrange(3)
                w[at : at + (how != 1)] = [] if how == 2 else [rng.choice(WORDS)]
            lines.append((" " if rng.random() < 0.2 else "") + " ".join(w))
        texts.append("\n".join(lines))
    texts += [sentence(rng, 3000), texts[-1]]
    want = brute_lines(list(enumerate(texts)))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in linededup.dedup(docs_of(spark, texts)).collect()}
    assert {i: t for i, (t, _, _) in got.items()} == want
    assert got[0][1:] == (0, 0) and got[1][1:] == (1, 0) and sum(d for _, _, d in got.values()) > 40
    same = linededup.dedup(docs_of(spark, [texts[7], texts[7]], [1, 1])).collect()
    assert len(same) == 2 and same[0] == same[1]
    assert linededup.dedup(docs_of(spark, [])).count() == 0
    assert linededup.cleaned(docs_of(spark, texts)).columns == [*docs_of(spark, []).columns, "_n_lines", "_n_dropped"]


def test_chains_and_very_long_lines(spark):
    words = [f"w{k}" for k in range(12)]
    chain = [" ".join([f"x{j}" if j < k else w for j, w in enumerate(words)]) for k in range(6)]
    long = [f"y{k}" for k in range(30_000)]
    docs = docs_of(spark, [*chain, " ".join(long), " ".join([*long[:20_000], "other", *long[20_001:]]), " ".join([*long[:20_000], "other", "more", *long[20_002:]])])
    got = {r.doc_id: r.n_dropped for r in linededup.dedup(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: 1, 8: 1}


# --- near-dedup


def brute_components(rows, k, percent):
    def shingles(s):
        w = (s or "").encode().lower().split()
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for x in range(len(rows)):
        least[find(x)].append(rows[x][0])
    return {x: (len(sets[x]), min(least[find(x)])) for x in range(len(rows))}


def near_texts(rng, groups=12, size=8, words=60):
    out = []
    for _ in range(groups):
        base = sentence(rng, rng.randrange(20, words)).split(" ")
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_dedup_against_brute_force(spark, k, percent):
    rng = random.Random(k)
    texts = [*ODD, "ONE two", "one  two", "three four", *near_texts(rng), "word " * 30_000]
    ids = rng.sample(range(1000), len(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link(docs_of(spark, texts, ids), neardup.plan(k, percent)).collect()}
    for x, (n, least) in brute_components(list(zip(ids, texts, strict=True)), k, percent).items():
        assert got[ids[x]] == (n, least if n else ids[x], (least if n else ids[x]) == ids[x])


def test_a_large_group_of_near_copies_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4000)
    rng = random.Random(9)
    base = sentence(rng, 70).split(" ")
    texts = []
    for _ in range(250):
        w = list(base)
        for at in rng.sample(range(70), rng.choice((0, 1, 2, 3, 4, 5, 6))):
            w[at] = f"e{rng.randrange(9)}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in neardup.link(docs_of(spark, texts), neardup.plan(3, 85)).collect()}
    assert got == {x: least for x, (_, least) in brute_components(list(enumerate(texts)), 3, 85).items()}


def test_blocks_of_one_key_are_dealt_apart(spark):
    rows = spark.range(1000).selectExpr("id % 2 as key", "id as node", "id as n")
    plan = neardup._blocks(rows, F.lit(neardup.BLOCK // 10)).groupBy("key", "i", "j").applyInPandas(lambda pdf: pdf[["key"]], "key long")._jdf.queryExecution().toString()
    assert re.search(r"Exchange hashpartitioning\(key#\d+L?, i#\d+L?, j#\d+L?", plan), plan


def test_near_dedup_odd_tables(spark):
    assert neardup.link(docs_of(spark, []), neardup.plan()).count() == 0
    assert neardup.dedup(docs_of(spark, [None, ""])).count() == 2
    text = sentence(random.Random(1), 30)
    out = neardup.dedup(docs_of(spark, [text, text, text, "other words"], [5, 5, 7, None]))
    assert sorted((r.doc_id is None, r.doc_id) for r in out.collect()) == [(False, 5), (True, None)] and out.columns == docs_of(spark, []).columns


def test_keys_are_shared_within_the_distance():
    p = neardup.plan(3, 85)
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 1 << 24, (1, p.chunks * p.symbols)).astype(np.uint32)
    for _ in range(300):
        other = sig.copy()
        at = rng.choice(sig.shape[1], p.distance, replace=False)
        other[0, at] += 1
        assert set(neardup.keys(sig, p)[0]) & set(neardup.keys(other, p)[0])


# --- fingerprints


def test_fingerprints(spark):
    rng = random.Random(8)
    texts = [*ODD[:-1], *near_texts(rng, 3, 4), "word " * 3000]
    ids = rng.sample(range(100), len(texts))
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs_of(spark, texts, ids)).collect()}
    order = sorted(zip(ids, texts, strict=True), reverse=True)
    by_text = defaultdict(set)
    for k, (i, text) in enumerate(order):
        s, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        edited = s[: len(s) - len(s) // 2] + nxt[: len(s) // 2]
        r = got[i]
        assert r.n_chars == len(s) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == s:
            assert r.near_edited == 1
        by_text[s].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({f for v in by_text.values() for f in v}) >= len(by_text) - 3  # texts that differ in terms out of the band alone may agree
    assert fingerprints.fingerprints(docs_of(spark, [])).count() == 0
    lone = fingerprints.fingerprints(docs_of(spark, ["abcd"], [None])).first()
    assert lone.doc_id is None and lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and lone.near_next == 1


@pytest.mark.parametrize("far", [[], [2**63 - 1, -(2**63)]])
def test_the_next_row_over_many_ranges(spark, monkeypatch, far):
    monkeypatch.setattr(fingerprints, "RANGE", 3)
    ids = random.Random(2).sample(range(10_000), 60 - len(far)) + far
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(docs_of(spark, [f"t{i}" for i in ids], ids).select("doc_id", "text"), "text").collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"t{down[(k + 1) % 60]}" for k, i in enumerate(down)}


def test_ranges_hold_alike_many_whatever_the_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE", 50)
    rows = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 when id % 3 = 1 then null when id = 2 then 9223372036854775807 else id end as doc_id", "concat('t', id) as text")
    placed = rows.withColumn("_tie", F.xxhash64("text"))
    sizes = [r["count"] for r in placed.withColumn("_range", fingerprints._ranges(placed)).groupBy("_range").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 400
    got = {r.text: r.next_text for r in fingerprints.with_next(rows, "text").collect()}
    order = [r.text for r in placed.orderBy(F.desc_nulls_last("doc_id"), "_tie").collect()]
    assert got == {t: order[(k + 1) % 3000] for k, t in enumerate(order)}


def test_fingerprints_against_brute_force(spark):
    """Terms in the band, and subsets of subsets, worked out in plain Python over hashes that Spark gives."""
    rng = random.Random(9)
    texts = near_texts(rng, 4, 5)
    docs = docs_of(spark, texts)
    df = Counter()
    sets = {r.doc_id: set(r.t) for r in docs.select("doc_id", fingerprints._terms(F.col("text")).alias("t")).collect()}
    for own in sets.values():
        df.update(own)
    low, high = max(2, fingerprints.LOW * len(texts)), max(2, fingerprints.HIGH * len(texts))
    band = sorted(t for t, n in df.items() if low <= n <= high)
    subsets = list(enumerate(fingerprints.SUBSETS))
    h = {(r.t, k): r[f"h{k}"] for r in spark.createDataFrame([(t,) for t in band], "t int").select("t", *(F.xxhash64("t", F.lit(k)).alias(f"h{k}") for k, _ in subsets)).collect() for k, _ in subsets}
    want = {i: [[t for t in sorted(own & set(band)) if h[t, k] & ((1 << s) - 1) == 0] for k, s in subsets] for i, own in sets.items()}
    say = spark.createDataFrame(list(want.items()), "doc_id long, subsets array<array<int>>")
    say = {r.doc_id: r.s for r in say.select("doc_id", F.transform("subsets", lambda x: F.when(F.size(x) == 0, "-").otherwise(F.substring(F.lower(F.lpad(F.hex(F.xxhash64(x)), 16, "0")), 1, 8))).alias("s")).collect()}
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    for i, r in got.items():
        other = got[(i - 1) % len(texts)]
        assert r.fingerprint.split(":")[1:] == say[i]
        shares, at = [0.0], 0
        for n in fingerprints.DENSITIES.values():
            pairs = [(x, y) for x, y in zip(say[i][at : at + n], say[other.doc_id][at : at + n], strict=True) if x != "-" or y != "-"]
            shares.append(sum(x == y for x, y in pairs) / len(pairs) if len(pairs) > 1 else 0.0)
            at += n
        assert r.near_next == pytest.approx(1.0 if r.fingerprint == other.fingerprint else max(shares))


# --- classifiers


def labelled(rng, good, bad, n=240):
    texts, y = [], []
    for k in range(n):
        y.append(k % 3 != 0)
        w = sentence(rng, rng.randrange(15, 40)).split(" ")
        if not y[-1]:
            w = bad(w)
        texts.append(good(w) if y[-1] else " ".join(w))
    return texts, y


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_on_held_out_rows(spark):
    rng = random.Random(10)
    texts, y = labelled(rng, " ".join, lambda w: [x + "$$$" for x in w])
    texts = [*texts, None, "", "word " * 20_000]
    labels = spark.createDataFrame([(i, int(v), 0, "x") for i, v in enumerate(y)] + [(0, None, None, "x"), (None, 1, 0, "x"), (1, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    got = {r.doc_id: r for r in quality.query(docs_of(spark, texts), labels).collect()}
    assert len(got) == len(texts) and all(got[i].held_out == held(i) for i in got)
    assert np.mean([got[i].predicted == v for i, v in enumerate(y) if held(i)]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    none = quality.query(docs_of(spark, texts[:3]), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 3
    assert quality.query(docs_of(spark, []), labels).count() == 0


def test_scores_do_not_depend_on_the_block():
    rng = np.random.default_rng(1)
    m = quality.Model(rng.normal(size=1 << quality.BITS).astype(np.float32), 0.1)
    texts = ["abc def", "", None, "x", "abc abc abc abc"]
    assert np.allclose(quality.means(texts, m), np.concatenate([quality.means([t], m) for t in texts]))


def test_grams_against_plain_python():
    codes, starts = subwords.layout(["ab abc", "", "b\nab"])
    words = {int(a): int(b) for at, bu in subwords.grams(codes, (subwords.WORD,), 20) for a, b in zip(at, bu, strict=True)}
    text = "".join(map(chr, codes))
    by_word = defaultdict(set)
    for m in re.finditer(r"\S+", text):
        by_word[m[0]].add(words[m.start()])
    assert all(len(v) == 1 for v in by_word.values()) and len(words) == 4 and starts.tolist() == [0, 8, 10]
    three = {text[a : a + 3] for at, _ in subwords.grams(codes, (3,), 20) for a in at}
    assert three == {" ab", "ab ", "abc", "bc ", " b "}


def test_toxicity_sees_through_disguises(spark):
    rng = random.Random(11)
    insults = ["grumbler", "snotface", "dimwitted"]
    disguise = {"grumbler": "gr0mbler grumb1er g r u m b l e r gruuuumbler", "snotface": "sn0tf4ce $notface s-n-o-t-f-a-c-e", "dimwitted": "d1mw1tted d!mwitted dimwitt3d"}
    texts, y = [], []
    for k in range(300):
        w = sentence(rng, rng.randrange(15, 40)).split(" ")
        y.append(k % 3 == 0)
        if y[-1]:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        texts.append(" ".join(w))
    hidden = [f"{sentence(rng, 8)} {d} {sentence(rng, 8)}" for word in insults for d in ([disguise[word]] if " " not in disguise[word] else re.split(r" (?=\S{4})", disguise[word]))]
    texts += [*hidden, None, "", "word " * 20_000]
    labels = spark.createDataFrame([(i, 1, int(v), 1.0) for i, v in enumerate(y)], "doc_id long, quality int, toxic int, score double")
    got = {r.doc_id: r for r in toxicity.query(docs_of(spark, texts), labels).collect()}
    assert np.mean([got[i].predicted == v for i, v in enumerate(y) if held(i)]) > 0.95
    caught = [got[300 + k].predicted for k in range(len(hidden))]
    assert np.mean(caught) >= 0.7, list(zip(hidden, caught, strict=True))
    assert not any(got[i].predicted for i in range(len(texts) - 3, len(texts)))
    assert toxicity.query(docs_of(spark, []), labels).count() == 0
    assert [r.score for r in toxicity.query(docs_of(spark, texts[:2]), labels.limit(0)).collect()] == [0.5] * 2


def test_readings_follow_the_model():
    counts = np.zeros(toxicity._ALPHABET**3, np.int64)
    for word in ["idiot"] * 50 + ["ideal"] * 20 + ["riot"] * 20:
        a = toxicity._folded(subwords.layout([word])[0])
        np.add.at(counts, (a[:-2] * toxicity._ALPHABET + a[1:-1]) * toxicity._ALPHABET + a[2:], 1)
    model = toxicity.log_model(counts).tolist()
    for run in ("1d10t", "!diot", "i d i o t", "i.d.i.o.t", "idiooot", "id-iot"):
        assert "idiot" in toxicity.readings(run, model), run
    assert toxicity.restored("a clean text, it is", lambda run: ["no"]) == "a clean text, it is"


def test_readings_are_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    model = np.log(rng.dirichlet(np.ones(toxicity._ALPHABET), (toxicity._ALPHABET, toxicity._ALPHABET))).tolist()
    for run in ("*1*#|b", "a a 1 6", "##**##", "g00o..d"):
        best = defaultdict(lambda: -np.inf)
        for path in itertools.product(*toxicity._choices(run)):
            a, b, score, text = 0, 0, 0.0, ""
            for letter, cost in path:
                score += cost
                if letter is not None:
                    score += model[a][b][letter]
                    a, b, text = b, letter, text + (" " if letter == 0 else toxicity.LETTERS[letter - 1] if letter < toxicity._ALPHABET - 1 else "?")
            best[text] = max(best[text], score + model[a][b][0])
        assert toxicity.readings(run, model) == sorted(best, key=best.get, reverse=True)[: toxicity.READINGS], run


def test_long_runs_are_decoded_whole():
    counts = np.zeros(toxicity._ALPHABET**3, np.int64)
    a = toxicity._folded(subwords.layout(["idiot"] * 50)[0])
    np.add.at(counts, (a[:-2] * toxicity._ALPHABET + a[1:-1]) * toxicity._ALPHABET + a[2:], 1)
    model = toxicity.log_model(counts).tolist()
    run = " ".join("idiot" * 100)
    assert toxicity.suspicious(f"x {run} ,") == [f"x {run}"] and "idiot" * 100 in toxicity.readings(run, model)[0].replace(" ", "")
    assert toxicity.suspicious("b1" * 40 + "d") == ["b1" * 40 + "d"]


# --- secrets


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_against_brute_force(spark):
    rng = random.Random(12)
    bits = ["password", "PassWD = ", "token:", "secret", "api_key='", "apikey", "API_KEY", '"', " ", ":", "=", "AKIA", "AKIAAKIA", "ABCDEFGHIJKLMNOP0", "deadbeef" * 3, "deadbeef", "x9Kq+/", "abc", "é", "ſecret=abcdefg", "toKen=abcdefgh", "\n", "-.", "toKen", "pwd: xK9#mQ2$vL7!", "https://bob:hunter2Zq9xWv@h/"]
    texts = [*ODD, *("".join(rng.choice(bits) for _ in range(rng.randrange(2, 14))) for _ in range(300))]
    got = {r.doc_id: r for r in secrets.digest(secrets.scan(docs_of(spark, texts))).collect()}
    for i, text in enumerate(texts):
        want = brute_secrets(text)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x.startswith(k) for x in want.split(",")) for k in ("assign", "access", "hex"))
    assert sum(r.n_guess for r in got.values()) > 5
    assert secrets.scan(docs_of(spark, [])).count() == 0


def test_guess_costs_are_in_order():
    ranks = {w: k for k, w in enumerate(["password", "monkey", "river", "stone"], 1)}
    cost = lambda v: secrets.guess_cost(v, ranks)
    assert cost("password") < cost("Password") < cost("p4ssw0rd") < 3
    assert cost("abcabcabcabc") < cost("abcdxyzqwvut") and cost("qwertyuiop") < 6 and cost("1999-12-31") < 6
    assert cost("riverstone") < 4 < cost("rvxqzstmkb") and cost("x9K#q2Lm!zR7w") >= secrets.GUESSES and cost("") == 0


def test_the_vocabulary_is_that_of_whole_texts(spark):
    docs = docs_of(spark, ["pad " * 5000 + "zebra zebra password = yakyak7", "zebra yak", None])
    found = docs.sparkSession.createDataFrame([("yakyak7",)], "value string")
    got = {r.w: r.guesses for r in secrets.vocabulary(docs, found).collect()}
    size = len("pad " * 5000 + "zebra zebra password = yakyak7") + len("zebra yak")
    assert got == {"pad": size / 20_000, "zebra": size / 18, "password": size / 9, "yak": size / 4}


def test_guess_spans_against_brute_force(spark):
    rng = random.Random(21)
    values = ["river", "riverstone77", "x9K#q2Lm!zR7w", "hunter", "qwertyuiop12", "ab" * 30, "Stone-River-1999", "deadbeef" * 3, "zqxwvutsrq", "".join(rng.choice("abcdefghijkmnop") for _ in range(40))]
    texts = [*ODD, *(f"{rng.choice(['password: ', 'token = ', 'login is ', 'https://u:'])}{v}{rng.choice([' ', '@h/ ', chr(10)])}the river has a stone and the stone a river" for v in values for _ in range(3))]
    got = {r.doc_id: [(s.kind, s.start, s.end, s.cost) for s in r.spans] for r in secrets.scan(docs_of(spark, texts)).collect()}
    words, size = Counter(), sum(len(t or "") for t in texts)
    for t in texts:
        words.update(re.findall(r"[^\W\d_]+", (t or "").lower()))
        for _, _, v in secrets.places(t or ""):
            words.subtract(re.findall(r"[^\W\d_]+", v.lower()))
    guesses = {w: size / (n * (len(w) + 1)) for w, n in words.items() if n > 0 and 3 <= len(w) <= 32} | {w: k for k, w in enumerate(dict.fromkeys(secrets.COMMON), 1)}
    for i, text in enumerate(texts):
        want = [("guess", a, b) for a, b, v in secrets.places(text or "") if secrets.guess_cost(v, guesses) >= secrets.GUESSES]
        assert [x[:3] for x in got[i] if x[0] == "guess"] == want and all((c is None) == (k != "guess") for k, _, _, c in got[i])
    assert 0 < sum(x[0] == "guess" for own in got.values() for x in own) < 30


# --- token counts


def test_rollups_follow_a_recount(spark, tmp_path):
    rng = random.Random(13)
    texts = [None, "", *(sentence(rng, rng.randrange(1, 30)) for _ in range(20))]
    docs = docs_of(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string"))))
    rows = rollups.counted(docs)
    ledger = rollups.Rollups(spark, str(tmp_path / "ledger"))
    assert ledger.totals().count() == 0 and ledger.batches() == []
    gone, changed = rows.where("doc_id % 5 = 0"), rows.where("doc_id % 5 = 1")
    after = changed.withColumn("n_tokens", F.col("n_tokens") + 7).withColumn("source", F.lit("new"))
    assert ledger.commit("b2", rollups.deleted(gone)) and ledger.commit("b1", rollups.inserted(rows)) and ledger.commit("b3", rollups.revised(changed, after))
    assert not ledger.commit("b1", rollups.inserted(rows)) and ledger.batches() == ["b1", "b2", "b3"]
    with pytest.raises(ValueError):
        ledger.commit("../x", rollups.inserted(rows))
    want = rollups.summed(rollups.inserted(rows.where("doc_id % 5 > 1").unionByName(after)))
    assert sorted(map(str, ledger.totals().collect())) == sorted(map(str, want.collect()))
    assert ledger.compact() and not ledger.compact() and sorted(map(str, ledger.totals().collect())) == sorted(map(str, want.collect()))
    assert not ledger.commit("b2", rollups.deleted(gone)) and ledger.commit("b4", rollups.inserted(gone)) and ledger.commit("b5", rollups.deleted(gone))
    assert sorted(map(str, ledger.totals().collect())) == sorted(map(str, want.collect())) and ledger.compact()
    assert not ledger._publish("commits/b4", "data/b4", rollups.inserted(gone), [])  # a second writer that came as far as the marker
    (tmp_path / "ledger" / "commits" / "b6").touch()  # a writer that was lost after its marker
    rollups.summed(rollups.inserted(gone)).write.parquet(str(tmp_path / "ledger" / "data" / "b6" / "x"))
    more = rollups.summed(want.unionByName(rollups.inserted(gone)))
    assert sorted(map(str, ledger.totals().collect())) == sorted(map(str, more.collect()))
    import tiktoken

    for version in rollups.VERSIONS:
        file, pattern = tokenizing.public_vocabulary(version)
        plain = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(file, "rb"))}, special_tokens={})
        n = {r.doc_id: r.n_tokens for r in rows.where(F.col("tokenizer") == version).collect()}
        assert n == {i: len(plain.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    ledger.drop()
    assert ledger.batches() == [] and rollups.query(docs_of(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


# --- pages


PAGES = "page_id long, url string, html string, text string, host string, row long"


def extracted(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", "y", 1) for i, (u, h) in enumerate(rows)], PAGES)
    return {r.page_id: r for r in htmltext.extract(df).collect()}


def test_marked_articles():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>H</header><div class="side-bar x">S1</div><nav><a>N</a></nav>
    <article class="post"><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four &lt;x&gt; <div class=ad>buy</div><aside>no</aside><script>var a="</p>"</script><ul><li>five<li>six</ul>
    <form><p>mail</p></form><section id="comments"><article><p>reader</p></article></section></article><footer>F &copy;</footer></body>"""
    assert [t for t, kind in htmltext.blocks(page) if kind == htmltext.INSIDE] == ["A & B", "one two three", "four <x>", "five", "six"]
    assert [t for t, kind in htmltext.blocks("<div class='ad'>never closed<article><p>kept &a</article>") if kind == htmltext.INSIDE] == ["kept &a"]
    assert htmltext.blocks("<main><p>m</p></main><p>o</p>") == [("m", 1), ("o", 0)]
    assert htmltext.blocks("a < b <3 <p") == [("a < b <3", 2)]


def test_pages_without_a_marked_article(spark):
    rng = random.Random(14)
    notice = "we keep small files on your machine to remember who you are"
    bodies = [sentence(rng, 30) for _ in range(6)]
    rows = [("http://a.example/1", f"<p>{notice}</p><div>{b}</div><p>{notice} {k}</p>") for k, b in enumerate(bodies)] + [("http://b.example/", f"<p>{notice}</p><div>{bodies[0]}</div>"), ("x", None), (None, ""), ("x", "<nav>only</nav>")]
    got = extracted(spark, rows)
    for k, b in enumerate(bodies):
        assert got[k].text == f"{b}\n{k}" and got[k].n_chars == len(got[k].text)
    assert got[6].text == f"{notice}\n{bodies[0]}"  # nothing repeats on that host
    assert [got[k].text for k in (7, 8, 9)] == ["", "", ""] and got[9].url == "x"
    assert extracted(spark, [("u", "<p>" + "word " * 50_000)])[0].n_chars == 249_999


def test_shards_of_a_host_meet_by_name(spark, monkeypatch):
    monkeypatch.setattr(htmltext, "SHARD", 30)
    rng = random.Random(15)
    notice = sentence(rng, 9)
    bodies = [sentence(rng, 15) for _ in range(8)]
    got = extracted(spark, [("http://a.example", f"<p>{b}<p>{notice}") for b in bodies])
    assert [got[k].text for k in range(8)] == bodies


def test_repeats_against_brute_force():
    rng = random.Random(16)
    for n in (12, 1, 3):
        streams = [[rng.choice("abc") for _ in range(rng.randrange(1, 40))] for _ in range(n)] + [["a"] * 30]
        has = defaultdict(set)
        for k, s in enumerate(streams):
            for i in range(len(s) - 3):
                has[tuple(s[i : i + 4])].add(k)
        covered, common, single, names = htmltext.repeated(htmltext.hashed([c for s in streams for c in s]), np.array([len(s) for s in streams]), 4)
        at, by_name = 0, defaultdict(set)
        for k, s in enumerate(streams):
            cov, com = set(), set()
            for i in range(len(s) - 3):
                by_name[int(names[at + i])].add(tuple(s[i : i + 4]))
                own = has[tuple(s[i : i + 4])]
                assert bool(single[at + i]) == (len(own) == 1)
                cov.update(range(i, i + 4) if len(own) > 1 else ())
                com.update(range(i, i + 4) if len(own) > 1 and len(own) >= max(4, len(streams) / 4) else ())
            assert set(np.flatnonzero(covered[at : at + len(s)])) == cov and set(np.flatnonzero(common[at : at + len(s)])) == com
            at += len(s)
        assert all(len(v) == 1 for v in by_name.values()) and len(by_name) == len(has)


def test_suffix_array_against_sorting():
    rng = random.Random(17)
    streams = [[rng.choice("ab") for _ in range(rng.randrange(1, 50))] for _ in range(6)] + [["a"] * 40, ["a"] * 40]
    flat = [c for s in streams for c in s]
    left = np.concatenate([np.arange(len(s), 0, -1) for s in streams])
    order, common = htmltext.suffixes(np.array([ord(c) - 97 for c in flat]), left)
    own = [tuple(flat[k : k + left[k]]) for k in order]
    assert own == sorted(own) and sorted(order.tolist()) == list(range(len(flat)))
    for k in range(1, len(own)):
        n = 0
        while n < min(len(own[k]), len(own[k - 1])) and own[k][n] == own[k - 1][n]:
            n += 1
        assert common[k] == n


def test_repeats_decide_what_stands_beside_an_article(spark, sf, monkeypatch):
    monkeypatch.setattr(htmltext, "SEEN", 50)
    rng = random.Random(18)
    menu, box = sentence(rng, 12), sentence(rng, 15)
    rows = []
    for _ in range(20):
        body, quote = sentence(rng, 60), sentence(random.Random(5), 20)
        rows.append(("http://a.example/", f"<div class=top>{menu}</div><article><p>{body}</p><p>{quote if len(rows) < 2 else sentence(rng, 20)}</p><div class=box>{box}</div></article><div class=lead>{sentence(rng, 20)}</div>"))
    got = extracted(spark, rows)
    for k, (_, html) in enumerate(rows):
        ps = re.findall("<p>(.*?)</p>", html)
        assert got[k].text.split("\n") == [*ps, re.search("lead>(.*?)<", html)[1]], k  # quoted paragraphs stay, the menu and the box go
    off = htmltext.extract(spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string"), 10**6).collect()
    assert all(menu in r.text and box in r.text for r in off)


def test_extraction_on_marked_pages_and_without_the_method(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    marked = {r.page_id: "\n".join(t for t, kind in htmltext.blocks(r.html) if kind == htmltext.INSIDE) for r in pages.collect()}
    assert {r.page_id: r.text for r in htmltext.extract(pages).collect()} == marked
    off = {r.page_id: r.text for r in htmltext.extract(pages, 10**6).collect()}
    assert sum(off[i] != marked[i] for i in marked) > 0.9 * len(marked)
