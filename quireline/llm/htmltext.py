"""Main text of web pages by a suffix array over each host's whole page streams.

Tags separate blocks and guard a marked article; what is boilerplate, repeats say. The token streams of a host's distinct
pages are concatenated (a large host in shards of bounded size), their suffixes sorted by prefix doubling, and the longest
prefix that a suffix shares with another page is read from the array of common prefixes. Long ones are covered runs.

On a page that marks no article covered runs go and unique ones stay. On a page that marks one, its blocks stay, quoted
paragraphs too, and each other block goes or stays with its slot, that is its place among the elements: a slot of which
repeats cover far more than of the corpus holds menus, headers, footers or notices, and goes whole; one that isn't repeated
stays. Blocks that are named menus, headers, footers or notices go, all of them, where repeats bear such names out: where any
of the corpus' is repeated, be it a word at a block's border. Inside an article a slot goes only if runs on many of a host's
pages cover half of it, and never most of the article.
What repeats can't tell, since it is different on each page, goes by its tags and names: forms, reader comments, asides,
adverts. No decision asks how much was seen: a page that is alone on its host is judged by what the corpus has in its slots,
and what no host with several pages has goes if it stands outside a marked article.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.llm.common import durable, small

#: Tokens of the shortest substring that counts as repeated.
REPEAT = 8
#: Tokens of the streams that one suffix array is built over, about.
SHARD = 100_000
#: A slot holds boilerplate from so many times the covered share of all tokens on, and from this share on in any case.
TIMES, HALF = 3.0, 0.5
#: Tokens that a host must have of a slot for its own share to weigh as much as the corpus'.
SEEN = 500
#: Tokens that a border of a block counts for, next to what two pages have there in the same slot.
BORDER = 7
#: A run is common if so many pages of a shard, and this part of them, have it.
COMMON_PAGES, COMMON_PART = 4, 0.25

# Elements and names that aren't an article's text.
OUT = set("nav header footer aside form menu dialog button select option textarea label fieldset head iframe object canvas svg math audio video map".split())
OUT_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe subscription signup related recommended share sharing social comment comments reply replies discussion disqus respond footer header masthead toolbar pagination pager widget skip hidden copyright".split())
# Of these, what is different on each page: repeats can't tell it from an article's text.
OWN = set("aside form dialog button select option textarea label fieldset iframe object canvas svg math audio video map".split())
OWN_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar related recommended share sharing social comment comments reply replies discussion disqus respond hidden modal popup".split())
# What holds a page or an article isn't out by a name; a heading or paragraph only by a whole class, not by a part of one.
HOLDERS = set("html body main article".split())
WHOLE_NAMES = set("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br".split())
LOOSE = set("p li dt dd tr td th thead tbody tfoot option colgroup".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.IGNORECASE)
_PARTS = re.compile(r"[^a-z0-9]+")

#: Of a block: out by structure; in the page's article; on a page without a marked one; beside a marked one, with a name of what is out or without.
OUTSIDE, INSIDE, OPEN, NAMED, BESIDE = 0, 1, 2, 3, 4


def _out(tag: str, attributes: str) -> int:
    """0 for what may be text, 1 for what structure calls boilerplate, 2 for what is out in any case."""
    if tag in OUT:
        return 1 + (tag in OWN)
    out = 0
    if attributes and not attributes.isspace():
        for name, *values in _NAMED.findall(attributes):
            value = next((v for v in values if v), "").lower()
            name = name.lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return 2
            if name == "role" and value in OUT_ROLES:
                out = max(out, 1)
            elif name in ("class", "id") and tag not in HOLDERS:
                parts = value.split() if tag in WHOLE_NAMES else _PARTS.split(value)
                out = max(out, 2 if not OWN_NAMES.isdisjoint(parts) else 1 if not OUT_NAMES.isdisjoint(parts) else 0)
    return out


_FORM_END = re.compile(r"</form\b", re.IGNORECASE)


def _wraps(page: str, start: int) -> bool:
    """Whether a form from there on holds most of the page: servers of some kinds put all they send into one."""
    end = _FORM_END.search(page, start)
    return 2 * ((end.start() if end else len(page)) - start) > len(page)


_CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")


def _slot(above: int, tag: str, attributes: str) -> int:
    """Names a place among the elements: that of the element above, the tag and its classes less their digits."""
    own = _CLASS.search(attributes) if attributes else None
    return xxhash.xxh64_intdigest(f"{tag}.{_DIGITS.sub('', own[1] or own[2] or own[3] or '') if own else ''}", above)


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of the page's blocks in order, by structure alone: INSIDE its article, OUTSIDE it, or OPEN where no article is marked.

    >>> blocks("<nav>Home</nav><article><h1>A &amp; b</h1><p>one\\n two<p>three</article>")
    [('Home', 0), ('A & b', 1), ('one two', 1), ('three', 1)]
    """
    return [(text, OUTSIDE if kind in (NAMED, BESIDE) else kind) for text, kind, _ in parsed(page)]


def parsed(page: str | None) -> list[tuple[str, int, int]]:
    """(text, kind, slot) of the page's blocks in order.

    >>> [kind for _, kind, _ in parsed("<nav>Home</nav><article><p>one</article><aside>more</aside>")]
    [3, 1, 0]
    """
    if not page:
        return []
    out: list[tuple[str, int, int, int]] = []  # text, how much it is out, 2 in an article, 1 in main, else 0, slot
    pieces: list[str] = []
    stack: list[tuple[str, int, int, int, int]] = []  # tag, how much out, as above, open elements of an inline tag, slot
    left, depth, slot, at = 0, 0, 0, 0

    def flush():
        if pieces:
            if text := " ".join("".join(pieces).split()):
                out.append((text, left, depth, slot))
            pieces.clear()

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            pieces.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[2] or m[5]) == "/", m[4] or m[7] or ""
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif closing:  # ends an inline element only if it was left out, within its block
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE or stack[k][0] == tag), -1)
                if k < 0 or stack[k][0] != tag:
                    continue
                if stack[k][3] > 1:
                    stack[k] = (*stack[k][:3], stack[k][3] - 1, stack[k][4])
                    continue
            else:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE or stack[k][0] == tag), -1)
                if k >= 0 and stack[k][0] == tag and tag not in VOID and not attributes.endswith("/"):  # one more of its kind inside
                    stack[k] = (*stack[k][:3], stack[k][3] + 1, stack[k][4])
                    continue
                if not _out(tag, attributes):
                    continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif not attributes.endswith("/"):
            if tag in LOOSE:  # closed by the next of its kind
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] not in LOOSE:
                        break
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            own = _out(tag, attributes)
            if own and tag == "form" and _wraps(page, m.end()):
                own = 0
            if tag in ("article", "main") and not own:  # ends what was left unclosed before it
                while stack and stack[-1][1] and not any(s[2] for s in stack):
                    stack.pop()
            before = stack[-1] if stack else ("", 0, 0, 1, 0)
            stack.append((tag, max(own, before[1]), max(before[2], 2 if tag == "article" else 1 if tag == "main" else 0), 1, _slot(before[4], tag, attributes)))
        left, depth, slot = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (0, 0, 0)
    pieces.append(entities.unescape(page[at:]))
    flush()
    level = max((d for _, gone, d, _ in out if not gone), default=0)

    def kind(gone: int, d: int) -> int:
        if not level:
            return OUTSIDE if gone else OPEN
        return (OUTSIDE if gone else INSIDE) if d >= level else (BESIDE, NAMED, OUTSIDE)[gone]

    return [(text, kind(gone, d), s - (1 << 63)) for text, gone, d, s in out]


def host(url: str | None) -> str:
    """
    >>> host("https://User@News.Example.org:80/a?b")
    'news.example.org'
    """
    return re.split(r"[/?#]", (url or "").split("//", 1)[-1], maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def suffixes(ids: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the one before it) of concatenated streams.

    ``left`` is how many tokens there are up to the end of each place's stream, where its suffix ends.
    """
    n = len(ids)
    rank, span, levels = ids.astype(np.int64), 1, []
    count = int(rank.max()) + 1 if n else 0
    while True:
        levels.append(rank)
        ahead = np.full(n, -1, np.int64)
        ahead[:-span] = rank[span:] if span < n else -1
        ahead[left <= span] = -1
        values, grown = np.unique((rank + 1) * (n + 2) + ahead + 1, return_inverse=True)
        if len(values) == count and len(levels) > 1 or span >= n:  # nothing was told apart that wasn't before
            break
        rank, span, count = grown, span * 2, len(values)
    order = np.argsort(rank, kind="stable")
    common = np.zeros(n, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        shared = np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
            same = (left[a] - shared >= 1 << k) & (left[b] - shared >= 1 << k) & (levels[k][x] == levels[k][y])
            shared += same.astype(np.int64) << k
        whole = rank[a] == rank[b]  # the same up to the end of their streams
        common[1:] = np.where(whole, left[a], shared)
    return order, common


def shared_prefixes(order: np.ndarray, common: np.ndarray, page: np.ndarray) -> np.ndarray:
    """For each place the longest prefix of its suffix that another page has."""
    n = len(order)
    of = page[order]
    out = np.zeros(n, np.int64)
    before, after = common.copy(), np.append(common[1:], 0)
    for k in np.flatnonzero(of[1:] == of[:-1]).tolist():  # a neighbour of the same page passes on what it shares
        before[k + 1] = min(before[k + 1], before[k])
    for k in np.flatnonzero(of[1:] == of[:-1])[::-1].tolist():
        after[k] = min(after[k], after[k + 1])
    out[order] = np.maximum(before, after)
    return out


def _runs(flags: np.ndarray) -> np.ndarray:
    """Begin, end, begin, ... of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))


def _cover(at: np.ndarray, size: np.ndarray, n: int) -> np.ndarray:
    edge = np.bincount(at, minlength=n + 1) - np.bincount(at + size, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def hashed(tokens: list[str]) -> np.ndarray:
    """24 bits a token: runs of many tokens are compared, so that is enough to tell them apart."""
    ids, values = pd.factorize(np.array(tokens, dtype=object))
    return np.array([xxhash.xxh32_intdigest(v) >> 8 for v in values], np.uint32)[ids] if len(tokens) else np.zeros(0, np.uint32)


def _mixed(tokens: np.ndarray) -> np.ndarray:
    token = (tokens.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return token ^ (token >> np.uint64(31))


def _met(name: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Which names another page has too."""
    _, which = np.unique(name, return_inverse=True)
    streams = int(page.max()) + 1
    return np.bincount(np.unique(which * streams + page) // streams)[which] > 1


def whole(tokens: np.ndarray, sizes: np.ndarray, slots: np.ndarray, page: np.ndarray, length: int = REPEAT) -> tuple[np.ndarray, np.ndarray]:
    """Of blocks of these sizes in a row, with their ``hashed`` tokens, slots and pages: whether another page has the block whole in
    the same slot, and whether one has its first or last token at that border there, if with the borders that is of ``length``."""
    block, first, last = block_names(tokens, sizes, slots)
    return _met(block, page) & (sizes + 2 * BORDER >= length), (_met(first, page) | _met(last, page)) & (1 + BORDER >= length)


def block_names(tokens: np.ndarray, sizes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What blocks, their first and their last tokens are met by, each in its slot."""
    begin = np.cumsum(sizes) - sizes
    slot = slots.astype(np.int64).view(np.uint64)
    mixed, spread = _mixed(tokens), np.uint64(0xD6E8FEB86659FD93)
    power = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    name = np.add.reduceat(mixed * power[np.arange(len(tokens)) - np.repeat(begin, sizes)], begin)
    return (name ^ (name >> np.uint64(29))) * spread + slot, mixed[begin] * spread + slot, mixed[begin + sizes - 1] * spread + slot


def repeated(tokens: np.ndarray, sizes: np.ndarray, length: int = REPEAT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the ``hashed`` tokens of streams of these sizes in a row: whether a run of ``length`` or more that another stream has covers
    them, whether one that many streams have does, whether a window of ``length`` that no other stream has begins there, and
    that window's name."""
    n, streams = len(tokens), len(sizes)
    _, ids = np.unique(tokens, return_inverse=True)
    page = np.repeat(np.arange(streams), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    order, common = suffixes(ids, left)
    shared = shared_prefixes(order, common, page)
    at = np.flatnonzero(shared >= length)
    covered = _cover(at, shared[at], n)
    group = np.cumsum(common < length)  # suffixes with the same window, in the array's order
    pairs = np.unique(group * streams + page[order])
    pages = np.bincount(pairs // max(1, streams), minlength=int(group[-1]) + 1 if n else 1)
    often = np.zeros(n, bool)
    often[order] = pages[group] >= max(COMMON_PAGES, COMMON_PART * streams)
    often = np.flatnonzero(often & (shared >= length))
    single = (left >= length) & (shared < length)
    with np.errstate(over="ignore"):
        token = _mixed(tokens)
        name = np.zeros(n, np.uint64)
        for k in range(length if length <= n else 0):  # a window that is longer than all streams begins nowhere
            name[: max(0, n - k)] = name[: max(0, n - k)] * np.uint64(0x9E3779B97F4A7C15) + token[k:]
        name = (name ^ (name >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return covered, _cover(often, np.full(len(often), length), n), single, name.astype(np.int64)


PARSED = "page_id long, url string, host string, h long, g long, n int, marked boolean, texts array<string>, kinds array<int>, slots array<long>"
#: Of several shards: windows that no other page of the shard has, and at -1 one of each that another has; blocks beside articles by the names
#: of the whole (0), the first (1) and the last token (2), with the tokens that nothing in the shard covers, one of each that the shard repeats without any.
FOUND = "host string, row long, spans array<int>, windows array<struct<at:int,name:long,slot:long,named:boolean>>, blocks array<struct<name:long,part:int,slot:long,n:int,named:boolean>>, seen array<struct<slot:long,total:long,covered:long,common:long>>, named long"


def parse(pages: DataFrame) -> DataFrame:
    """The blocks of each page, with a digest (h, g) and the number of tokens (n) of its whole stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [parsed(h) for h in batch.column(2).to_pylist()]
                streams = [" ".join(t for t, _, _ in own) for own in found]
                digest = [xxhash.xxh3_128_digest(s) for s in streams]
                columns = [
                    batch.column(0), batch.column(1), pa.array([host(u) for u in batch.column(1).to_pylist()], pa.string()),
                    pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digest], pa.int64()), pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digest], pa.int64()),
                    pa.array([s.count(" ") + 1 if s else 0 for s in streams], pa.int32()), pa.array([any(kind == INSIDE for _, kind, _ in own) for own in found], pa.bool_()),
                    pa.array([[t for t, _, _ in own] for own in found], pa.list_(pa.string())), pa.array([[k for _, k, _ in own] for own in found], pa.list_(pa.int32())), pa.array([[s for _, _, s in own] for own in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "h", "g", "n", "marked", "texts", "kinds", "slots"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, PARSED)


TOKENS = "host string, row long, shards int, shard int, tokens binary, sizes array<int>, kinds array<int>, slots array<long>"


def _tokens(rows: DataFrame) -> DataFrame:
    """(host, row, shards, shard, texts, kinds, slots) with the texts as hashed tokens, three bytes each, compressed by page, and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(write_checksum=False)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                split = [[t.split(" ") for t in own] for own in batch.column(4).to_pylist()]
                sizes = [[len(t) for t in own] for own in split]
                flat = hashed([w for own in split for t in own for w in t]).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
                ends = np.cumsum([sum(own) for own in sizes])
                tokens = [packer.compress(part.tobytes()) for part in np.split(flat, ends[:-1])]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(tokens, pa.binary()), pa.array(sizes, pa.list_(pa.int32())), *batch.columns[5:]], ["host", "row", "shards", "shard", "tokens", "sizes", "kinds", "slots"])

    return rows.select("host", "row", "shards", "shard", "texts", "kinds", "slots").mapInArrow(run, TOKENS)


def _beside(tokens: np.ndarray, sizes: np.ndarray, slots: np.ndarray, page: np.ndarray, kinds: np.ndarray, covered: np.ndarray, single: np.ndarray, length: int, borders: tuple[int, ...]) -> dict[int, list[dict]]:
    """By page the names by which its blocks beside an article may be met in other shards, of what the shard repeats one each. ``borders``:
    1 for first and 2 for last tokens, which are asked for only where the shard itself doesn't bear names out."""
    begin = np.cumsum(sizes) - sizes
    # What a block's own windows will cover once they are met is theirs to count.
    windows = np.concatenate(([0], np.cumsum(single)))
    own = np.add.reduceat(~covered, begin) - (windows[np.maximum(begin + sizes - length + 1, begin)] - windows[begin])
    out: dict[int, list[dict]] = {}
    for part, name in enumerate(block_names(tokens, sizes, slots)):
        if part and part not in borders:
            continue
        fits = sizes + 2 * BORDER >= length if part == 0 else np.full(len(sizes), 1 + BORDER >= length)
        at = np.flatnonzero(fits & ((kinds == NAMED) | (kinds == BESIDE) & (part == 0)))
        _, first, which = np.unique(name[at], return_index=True, return_inverse=True)
        shared = _met(name[at], page[at]) if len(at) else np.zeros(0, bool)
        for k in np.flatnonzero(~shared | (first[which] == np.arange(len(at)))).tolist():
            b = at[k]
            n = 0 if shared[k] or part else max(0, int(own[b]))
            out.setdefault(int(page[b]), []).append({"name": int(name[b].view(np.int64)), "part": part, "slot": int(slots[b]) if n else 0, "n": n, "named": bool(kinds[b] == NAMED) and not shared[k]})
    return out


def _arrays(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The suffix array of one shard: covered runs of each page, windows and blocks that other shards may have, and what covers each slot."""
        sizes = [np.asarray(own) for own in pdf["sizes"]]
        unpacker = zstandard.ZstdDecompressor()
        tokens = np.pad(np.frombuffer(b"".join(unpacker.decompress(t) for t in pdf["tokens"]), np.uint8).reshape(-1, 3), ((0, 0), (0, 1))).view("<u4").ravel()
        covered, common, single, names = repeated(tokens, np.array([own.sum() for own in sizes], np.int64), length)
        blocks = np.concatenate(sizes)
        page = np.repeat(np.arange(len(sizes)), [len(own) for own in sizes])
        every = np.concatenate([np.asarray(own) for own in pdf["slots"]])
        equal, edge = whole(tokens, blocks, every, page, length)
        either, edge = covered | np.repeat(equal, blocks), np.repeat(edge, blocks)
        several = bool(pdf["shards"].iloc[0] > 1)
        if several:
            ends = np.cumsum([own.sum() for own in sizes])
            left = np.repeat(ends, [own.sum() for own in sizes]) - np.arange(len(tokens))
            kinds_of = np.concatenate([np.asarray(own) for own in pdf["kinds"]])
            again = np.flatnonzero((left >= length) & ~single)
            again = np.sort(again[np.unique(names[again], return_index=True)[1]])  # one of each window that the shard repeats
            borne = bool((either | edge)[np.repeat(kinds_of == NAMED, blocks)].any())
            beside = _beside(tokens, blocks, every, page, kinds_of, either, single, length, () if borne else (1, 2))
        out, at = [], 0
        for own, kinds, slots, row in zip(sizes, pdf["kinds"], pdf["slots"], pdf["row"], strict=True):
            n = int(own.sum())
            here = slice(at, at + n)
            kind, slot = np.repeat(np.asarray(kinds), own), np.repeat(np.asarray(slots), own)
            windows = []
            if several:  # windows that touch text which repeats decide on
                decided = (kind == OPEN) | (kind == NAMED) | (kind == BESIDE)
                touched = np.cumsum(np.concatenate(([0], decided)))
                begin = np.flatnonzero(single[here])
                begin = begin[touched[np.minimum(begin + length, n)] > touched[begin]]
                windows = [{"at": int(k), "name": int(names[at + k]), "slot": int(slot[k]), "named": bool(kind[k] == NAMED)} for k in begin]
                windows += [{"at": -1, "name": int(names[k]), "slot": 0, "named": False} for k in again[np.searchsorted(again, at) : np.searchsorted(again, at + n)]]
            each, which = np.unique(slot, return_inverse=True)
            total, cov, com = (np.bincount(which, w, len(each)).astype(int) for w in (None, either[here], common[here]))
            seen = [{"slot": int(s), "total": int(t), "covered": int(c), "common": int(m)} for s, t, c, m in zip(each, total, cov, com, strict=True)]
            out.append((pdf["host"].iloc[0], row, _runs(covered[here]).astype("int32"), windows, beside.get(len(out), []) if several else [], seen, int((either | edge)[here][kind == NAMED].sum())))
            at += n
        return pd.DataFrame(out, columns=["host", "row", "spans", "windows", "blocks", "seen", "named"])

    return run


def extract(pages: DataFrame, length: int = REPEAT) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for each row of ``pages``; ``length``: tokens of the shortest run that counts as repeated.

    White space in a block becomes one space, blocks are joined by line feeds, character references are decoded. Null and
    empty pages, and pages without text, have the empty text. Rows that repeat are answered each; pages of a host with the same
    stream are one page to the suffix array, so copies don't make boilerplate of each other. Pages without an address are of
    one host without a name. Other columns aren't read.
    """
    own = durable(parse(pages).withColumn("row", F.monotonically_increasing_id()), level=9)
    distinct = durable(own.where("n > 0").groupBy("host", "h", "g").agg(F.min("row").alias("row"), F.first("n").alias("n")))
    hosts = durable(distinct.groupBy("host").agg(F.ceil(F.sum("n") / F.lit(SHARD)).cast("int").alias("shards"), F.count("*").alias("pages")))
    shards = distinct.join(small(hosts.where("pages > 1")), "host").select("row", "shards", F.pmod(F.xxhash64("h", "g"), F.col("shards")).cast("int").alias("shard"))
    dealt = own.select("row", "host", "texts", "kinds", "slots").join(small(shards), "row")
    dealt = _tokens(dealt).repartition("host", "shard")
    found = durable(dealt.groupBy("host", "shard").applyInPandas(_arrays(length), FOUND), level=9)

    # Windows and blocks of several shards, by name: of one shard they are at most one page's, so two pages' are in two shards.
    windows = found.select("host", F.xxhash64("host").alias("key"), "row", F.inline("windows"))
    met = windows.groupBy("key", "name").agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first < last").select("key", "name")
    across = durable(windows.where("at >= 0").join(met, ["key", "name"]).select("host", "row", "at", "slot", "named"), level=9)
    blocks = found.select("host", "row", F.inline("blocks")).groupBy("host", "part", "name")
    alike = durable(blocks.agg(F.min("row").alias("first"), F.max("row").alias("last"), F.max_by("slot", "n").alias("slot"), F.sum("n").alias("n"), F.bool_or("named").alias("named")).where("first < last and (n > 0 or named)"))

    # The last step reads a host's decisions and, for pages without a marked article, their covered runs.
    alone = own.where("marked").select("host", "slots").join(small(hosts.where("pages = 1").select("host")), "host").select("host", F.explode("slots").alias("slot")).distinct()
    met = across.select("host", "slot", F.lit(1).cast("long").alias("covered")).unionByName(alike.where("n > 0").select("host", "slot", F.col("n").alias("covered")))
    decided = small(decisions(found, met, alone), F.size("keep") + F.size("drop"))
    named = bool(found.agg(F.sum("named")).first()[0]) or any(found_across.where("named").head(1) for found_across in (across, alike))
    covered = found.select("row", "spans").join(across.groupBy("row").agg(F.collect_list("at").alias("more")), "row", "left")
    covered = covered.where("size(spans) > 0 or more is not null").join(distinct.select("row", "host", "h", "g"), "row").drop("row")
    unmarked = own.where("not marked").join(covered, ["host", "h", "g"], "left")
    marked = own.where("marked").join(decided, "host", "left")
    none, nothing = F.lit(None).cast("array<long>"), F.lit(None).cast("array<int>")
    common = ["page_id", "url", "texts", "kinds", "slots"]
    both = marked.select(*common, "keep", "drop", nothing.alias("spans"), nothing.alias("more")).unionByName(unmarked.select(*common, none.alias("keep"), none.alias("drop"), "spans", "more"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_text(*x, length, named) for x in zip(*(batch.column(c).to_pylist() for c in range(2, 9)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return both.mapInArrow(finish, "page_id long, url string, text string").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def decisions(found: DataFrame, across: DataFrame, alone: DataFrame) -> DataFrame:
    """(host, keep, drop): the slots beside marked articles that stay, and those inside that go, of hosts that have any.

    A host's share of covered tokens of a slot is mixed with the corpus' share of that slot, which is all there is of the slots
    of hosts with one page (``alone``).
    """
    none = F.lit(0).cast("long")
    seen = found.select("host", F.inline("seen")).unionByName(across.select("host", "slot", none.alias("total"), "covered", none.alias("common")))
    seen = seen.unionByName(alone.select("host", "slot", *(none.alias(c) for c in ("total", "covered", "common"))))
    sums = [F.sum(c).alias(c) for c in ("total", "covered", "common")]
    seen = durable(seen.groupBy("host", "slot").agg(*sums).withColumn("covered", F.least("covered", "total")))
    whole = seen.agg(*sums).first()
    share = (whole["covered"] or 0) / (whole["total"] or 1)
    corpus = seen.groupBy("slot").agg(*(F.sum(c).alias(f"all_{c}") for c in ("total", "covered", "common"))).where("all_total > 0")
    each = seen.join(corpus, "slot")
    mixed = lambda c: (F.col(c) + SEEN * F.col(f"all_{c}") / F.col("all_total")) / (F.col("total") + SEEN)
    keep = ~((F.col("all_covered") > 0) & (mixed("covered") >= min(HALF, TIMES * share)))
    drop = mixed("common") >= HALF
    said = each.select("host", F.when(keep, F.col("slot")).alias("keep"), F.when(drop, F.col("slot")).alias("drop")).where("keep is not null or drop is not null")
    return said.groupBy("host").agg(F.collect_list("keep").alias("keep"), F.collect_list("drop").alias("drop"))


def _text(texts: list[str], kinds: list[int], slots: list[int], keep: list[int] | None, drop: list[int] | None, spans: list[int] | None, more: list[int] | None, length: int, named: bool) -> str:
    """The blocks that stay, joined; of those of a page without a marked article, the runs that aren't covered. ``named``: names are borne out."""
    keep, drop = set(keep or ()), set(drop or ())
    if drop:
        inside = [(t.count(" ") + 1) * (1 if slot in drop else -1) for t, kind, slot in zip(texts, kinds, slots, strict=True) if kind == INSIDE]
        if sum(inside) > 0:  # what pages share is most of the article, so it is the text and not a box in it
            drop = set()
    gone = None
    if spans or more:
        gone = np.zeros(sum(t.count(" ") + 1 for t in texts), bool)
        for a, b in [*zip((spans or [])[::2], (spans or [])[1::2], strict=True), *((k, k + length) for k in more or [])]:
            gone[a:b] = True
    out, at = [], 0
    for text, kind, slot in zip(texts, kinds, slots, strict=True):
        n = text.count(" ") + 1
        if kind == INSIDE and slot not in drop or (kind == BESIDE or kind == NAMED and not named) and slot in keep or kind == OPEN and gone is None:
            out.append(text)
        elif kind == OPEN and (kept := [w for w, g in zip(text.split(" "), gone[at : at + n], strict=True) if not g]):
            out.append(" ".join(kept))
        at += n
    return "\n".join(out)
