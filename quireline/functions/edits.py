"""Edit distance of long texts: a column of bits a step instead of a column of numbers.

Differences between neighbouring cells of the distance table are -1, 0 or 1, so a whole column of them is two bit vectors, and
Python's whole numbers hold vectors of any length. Of texts that are much alike only cells near the diagonal matter: a band of
bits slides along it, and is made four times as wide as long as the distance doesn't fit.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Cells of the distance table up to which the engine's own function is used.
CELLS = 4_000_000
#: Half the width of the first band.
BAND = 64


def _whole(a: str, b: str) -> int:
    """Distance by all cells; columns run along ``a``."""
    bits = {c: _bits(a, c) for c in set(a)}
    last, every = len(a) - 1, (1 << len(a)) - 1
    up, down, score = every, 0, len(a)
    for c in b:
        same = bits.get(c, 0)
        flat = (((same & up) + up) ^ up) | same | down
        right_up, right_down = down | (every & ~(flat | up)), up & flat
        score += (right_up >> last & 1) - (right_down >> last & 1)
        right_up, right_down = (right_up << 1 | 1) & every, right_down << 1 & every
        either = same | down
        up, down = right_down | (every & ~(either | right_up)), right_up & either
    return score


def _bits(text: str, c: str) -> int:
    """Where a character stands, as bits."""
    out, at = bytearray(len(text) // 8 + 1), text.find(c)
    while at >= 0:
        out[at >> 3] |= 1 << (at & 7)
        at = text.find(c, at + 1)
    return int.from_bytes(out, "little")


def _banded(a: str, b: str, k: int) -> int | None:
    """Distance by the cells at most k from the diagonal, None if it is over k; ``a`` is at least as long as ``b``, and longer than the band is wide."""
    if len(a) - len(b) > k:
        return None
    places: dict[str, list[int]] = defaultdict(list)
    for i in range(len(a) - 1, -1, -1):
        places[a[i]].append(i)  # the next one is last
    width = 2 * k + 1
    every, windows = (1 << width) - 1, {}
    up, down, score = every ^ ((1 << (width - k - 1)) - 1), 0, k
    most, start, corner = 2 * k + len(b) - len(a), k + 1 - width, width - 2
    for i, c in enumerate(b):
        seen, at = windows.get(c, (0, start))
        seen >>= start - at
        ahead = places.get(c)
        while ahead and ahead[-1] < start + width:
            if (p := ahead.pop()) >= start:
                seen |= 1 << (p - start)
        windows[c] = seen, start
        flat = (((seen & up) + up) ^ up) & every | seen | down
        right_up, right_down = down | (every & ~(flat | up)), flat & up
        if i < len(a) - k:
            score += 1 - (flat >> (width - 1) & 1)
        else:
            score += (right_up >> corner & 1) - (right_down >> corner & 1)
            corner -= 1
        if score > most:
            return None
        flat >>= 1
        up, down = right_down | (every & ~(flat | right_up)), flat & right_up
        start += 1
    return score if score <= k else None


def distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements of code points from one text to the other."""
    if len(a) < len(b):
        a, b = b, a
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n = 0
    while n < len(b) and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not b:
        return len(a)
    k = BAND
    while 2 * k + 1 < len(a):
        if (d := _banded(a, b, k)) is not None:
            return d
        k *= 4
    return _whole(a, b)


@F.pandas_udf(IntegerType())
def _long(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


def edits(a: Column, b: Column) -> Column:
    """Edit distance of two texts of any length; null if one is null. Short ones stay in the engine, only long ones go to Python."""
    short = F.length(a).cast("long") * F.length(b) <= CELLS
    return F.when(short, F.levenshtein(a, b)).otherwise(_long(F.when(~short, a), F.when(~short, b)))
