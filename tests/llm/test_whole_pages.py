"""Main text stays behind a left-out inline element, and on copies of a page."""

import random

import numpy as np
import pytest

from quireline.llm import htmltext


def inside(page):
    return " ".join(t for t, kind in htmltext.blocks(page) if kind == htmltext.INSIDE)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p>A <span class=ad>x</span> B</p><p>C</p></article>", "A B C"),
        ("<article><div><a class=share>x</a><p>one</p><p>two</p></div></article>", "one two"),
        ("<article><a class=share>x <b>y</b> z</a><p>one</p><p>two</p></article>", "one two"),
        ("<article><p>A <span class=ad>x <span>y</span> z</span> B</p></article>", "A B"),
        ("<article><p>A <sup hidden>x</sup> B <span>C</span> D</p></article>", "A B C D"),
        ("<article><p>A <span class=ad>x</p><p>B</p></article>", "A B"),
        ("<article><p>A <span>b <a class=share>x</a> c</span> d</p></article>", "A b c d"),
    ],
)
def test_text_behind_a_left_out_inline_element(page, want):
    assert inside(page) == want


def test_copies_of_a_page_do_not_empty_each_other(spark):
    body = "a text of some length that two addresses of one host both give in full"
    notice = "all pages of this host say this one sentence at their very end"
    own = ["some other words stand here", "and here are words that differ"]
    pages = [("http://a.example/1", f"<p>{body}</p>"), ("http://a.example/2", f"<p>{body}</p>"), ("http://a.example/2", f"<p>{body}</p>")]
    pages += [("http://b.example/", f"<p>{t}</p><p>{notice}</p>") for t in own]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert got == {0: body, 1: body, 2: body, 3: own[0], 4: own[1]}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<body><form id="aspnetForm"><h1>Title</h1><p>Text of the page, which is most of it.</p></form></body>', ["Title", "Text of the page, which is most of it."]),
        ('<html class="menu-open"><body class="right-sidebar"><p>Text</p></body></html>', ["Text"]),
        ('<article class="share-price-report"><h1 class="post-header">T</h1><p class="comment-analysis">a</p><p class="public-notice-law">b</p></article>', ["T", "a", "b"]),
        ('<article><p class="comment">gone</p><div class="comment-list"><p>gone</p></div><p>stays</p></article>', ["stays"]),
        ('<article><p>a text of an article that goes on for a while</p><form><p>Sign up</p></form></article>', ["a text of an article that goes on for a while"]),
        ('<body hidden><p>gone</p></body>', []),
    ],
)
def test_names_that_hold_main_text(page, want):
    assert [t for t, kind in htmltext.blocks(page) if kind != htmltext.OUTSIDE] == want


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def texts_of(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in htmltext.extract(df).collect()}


def test_what_stands_beside_an_article_is_judged_the_same_at_every_size(spark):
    rng = random.Random(20)
    rows, want = [], []
    for k in range(80):
        title, body, lead = words(rng, 4), words(rng, 30), words(rng, 20)
        rows.append(("http://a.example/", f"<nav>Home News {words(rng, 9)}</nav><nav>About us</nav><div class=top>All of it</div><article><h1>{title}</h1><p>{body}</p></article><div class=lead>{lead}</div><footer>{words(rng, 20)}</footer>"))
        want.append(f"{title}\n{body}\n{lead}")
    rows.append(("http://alone.example/", rows[0][1]))
    want.append(want[0])
    for some in ([0, 1], [0, 1, 2, 80], [*range(81)]):  # 40 to 1,600 tokens of a slot
        assert texts_of(spark, [rows[k] for k in some]) == {i: want[k] for i, k in enumerate(some)}, len(some)


def test_names_alone_decide_where_nothing_can_be_compared(spark):
    page = "<nav>Home</nav><article><p>own text</p></article><div class=lead>more</div><footer>End</footer>"
    assert texts_of(spark, [("http://a.example/", page), ("http://b.example/", page)]) == {0: "own text", 1: "own text"}


def test_articles_that_are_alike_stay_at_every_size(spark):
    rng = random.Random(21)
    same, box = words(rng, 30), words(rng, 12)
    rows = [("http://a.example/", f"<article><h1>{words(rng, 4)}</h1><p>{same} {k}</p><div class=box>{box}</div></article>") for k in range(60)]
    for n in (6, 60):
        got = texts_of(spark, rows[:n])
        assert all(f"{same} {k}" in got[k] for k in range(n)), n


def test_a_box_in_articles_goes_at_every_size(spark):
    rng = random.Random(22)
    box, bodies = words(rng, 12), [words(rng, 30) for _ in range(100)]
    rows = [("http://a.example/", f"<article><p>{b}</p><div class=box>{box}</div></article>") for b in bodies]
    for n in (4, 100):
        assert texts_of(spark, rows[:n]) == dict(enumerate(bodies[:n])), n


def test_blocks_that_repeat_whole_against_counting():
    rng = random.Random(23)
    pages = [[(rng.randrange(2), [rng.choice("ab") for _ in range(rng.randrange(1, 4))]) for _ in range(rng.randrange(1, 5))] for _ in range(12)]
    blocks = [(k, slot, tuple(own)) for k, page in enumerate(pages) for slot, own in page]
    sizes = np.array([len(own) for _, _, own in blocks])
    args = htmltext.hashed([t for _, _, own in blocks for t in own]), sizes, np.array([slot for _, slot, _ in blocks]), np.array([k for k, _, _ in blocks])
    equal, edge = htmltext.whole(*args)
    want = [len({k for k, *other in blocks if other == [slot, own]}) > 1 for _, slot, own in blocks]
    assert True in want and False in want and equal.tolist() == want
    assert edge.tolist() == [any(len({k for k, other, o in blocks if other == slot and o[at] == own[at]}) > 1 for at in (0, -1)) for _, slot, own in blocks]
    assert not any(found.any() for found in htmltext.whole(*args, 10**6))


def test_a_word_at_a_border_bears_names_out(spark):
    rng = random.Random(24)
    bodies = [words(rng, 20) for _ in range(60)]
    rows = [("http://a.example/", f"<nav>menu {words(rng, 20)}</nav><article><p>{b}</p></article><footer>{words(rng, 20)}</footer>") for b in bodies]
    for n in (2, 60):
        assert texts_of(spark, rows[:n]) == dict(enumerate(bodies[:n])), n


def test_small_table_gives_the_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    marked = {r.page_id: "\n".join(t for t, kind in htmltext.blocks(r.html) if kind == htmltext.INSIDE) for r in pages.collect()}
    assert {r.page_id: r.text for r in htmltext.extract(pages).collect()} == marked


def test_a_run_that_one_shard_repeats_is_met_by_the_page_of_another(spark, monkeypatch):
    """Three pages a host over two shards: where two are in one, the third has the run alone in its own."""
    monkeypatch.setattr(htmltext, "SHARD", 50)
    rng = random.Random(21)
    pages, want = [], []
    for h in range(10):
        notice = words(rng, 10)
        for _ in range(3):
            want.append(words(rng, 20))
            pages.append((f"http://h{h}.example/", f"<p>{want[-1]}</p><p>{notice}</p>"))
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert [got[k] for k in range(len(want))] == want


@pytest.mark.parametrize("shard", [1, htmltext.SHARD])
@pytest.mark.parametrize("around", ['<div class="lead">{}</div><article>{}</article>', '<div class="nav">{}</div><article>{}</article>'])
def test_short_blocks_are_met_across_shards(spark, monkeypatch, shard, around):
    monkeypatch.setattr(htmltext, "SHARD", shard)
    rng = random.Random(22)
    want = [words(rng, 20) for _ in range(12)]
    pages = [(k, f"http://a.example/{k}", around.format("three words here", f"<p>{t}</p>")) for k, t in enumerate(want)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(len(want))] == want
