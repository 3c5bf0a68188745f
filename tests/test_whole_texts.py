"""Error rates over whole texts, against brute force."""

import pytest

from quireline.plans import catalog


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


REFS = {0: "plain words of a page " * 12, 1: "é ß 😀 " * 40 + "end", 2: "short", 3: "z" * 41 + "y" * 300}
HYPS = {0: "plain words of a page " * 11 + "plain wards of a paga ", 1: "è ß 😀 " * 40 + "fin", 2: "short and then some more " * 9, 3: "z" * 41 + "y" * 160, 4: "no reference " * 20}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame(list(HYPS.items()), "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(REFS.items()), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def rates(change=lambda s: s):
    return {i: round(edits(change(HYPS[i]), r) / len(r), 6) for i, r in REFS.items()}


def corpus(own):
    return sum(own[i] * len(r) for i, r in REFS.items()) / sum(map(len, REFS.values()))


def test_rates_are_those_of_whole_texts(spark, small):
    want = rates()
    got = {r.filename: r for r in catalog.QUERIES["cer_per_file"](spark, small).collect()}
    assert {f: (r.hyp_len, r.ref_len, r.cer) for f, r in got.items()} == {f"f{i}.txt": (len(HYPS[i]), len(r), pytest.approx(want[i], abs=1e-6)) for i, r in REFS.items()}
    whole = catalog.QUERIES["cer_corpus"](spark, small).first()
    assert whole.files == 4 and whole.cer == pytest.approx(corpus(want), abs=2e-6)
    rows = {r.filename: r for r in catalog.QUERIES["backend_compare"](spark, small).collect()}
    upper = rates(str.upper)
    for i, h in HYPS.items():
        r = rows[f"f{i}.txt"]
        assert (r.plain_len, r.upper_len) == (len(h), len(h.upper()))
        assert (r.plain_cer, r.upper_cer) == ((None, None) if i == 4 else (pytest.approx(want[i], abs=1e-6), pytest.approx(upper[i], abs=1e-6)))


def test_sweep_meets_whole_references(spark, small):
    got = {r.k: r.cer for r in catalog.QUERIES["sweep_cer"](spark, small).collect()}
    assert got == {k: pytest.approx(corpus(rates(lambda s, k=k: s[:k])), abs=2e-6) for k in (40, 80, 120)}


def test_references_are_whole(spark, small):
    got = {r.filename: r.ref for r in catalog.QUERIES["ocr_ref_candidates"](spark, small).collect()}
    assert got == {"f0.pdf": REFS[0], "f1.pdf": REFS[1], "f2.pdf": "ref: short", "f3.pdf": REFS[3], "f4.pdf": None}
