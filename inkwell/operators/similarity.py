"""Similarities that need Python: whole-text and word edit distances, multisets of tokens, matcher ratios."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bounded


def _codes(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Both sequences as numbers, equal where their items are."""
    if isinstance(a, str) and isinstance(b, str):
        return tuple(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    numbers: dict = {}
    return tuple(np.array([numbers.setdefault(t, len(numbers)) for t in s], np.uint32) for s in (a, b))


def _least(x: np.ndarray, y: np.ndarray) -> int:
    """A bound that no edit distance is below: what either has that the other lacks, repeats counted."""
    items, at = np.unique(np.concatenate((x, y)), return_inverse=True)
    more = np.bincount(at[: len(x)], minlength=len(items)) - np.bincount(at[len(x) :], minlength=len(items))
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def _within(short: list[int], long: list[int]) -> bool:
    """Whether the one is the other with items left out."""
    rest = iter(long)
    return all(t in rest for t in short)


def edit_distance(a, b) -> int:
    """Edit distance of two sequences, exactly.

    What both begin or end with alike is left out first, which changes no distance.  Then the distance lies between
    what either lacks of the other and what a plain alignment costs: item by item if they are equally long, or only
    leaving items out.  Where both bounds meet, which takes linear time, no matrix is needed.
    """
    if isinstance(a, str) and isinstance(b, str) and a == b:
        return 0
    x, y = _codes(a, b)
    most = min(len(x), len(y))
    apart = np.flatnonzero(x[:most] != y[:most])
    lo = int(apart[0]) if len(apart) else most
    apart = np.flatnonzero(x[lo:][::-1][: most - lo] != y[lo:][::-1][: most - lo])
    hi = int(apart[0]) if len(apart) else most - lo
    x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
    if len(x) < len(y):
        x, y = y, x
    if not len(y):
        return len(x)
    least = _least(x, y)
    if least == len(x):
        return least
    if len(x) == len(y):
        if np.count_nonzero(x != y) == least:
            return least
    elif least == len(x) - len(y) and _within(y.tolist(), x.tolist()):
        return least
    return _matrix_distance(x.tolist(), y.tolist())


def _matrix_distance(a, b) -> int:
    """Edit distance: a column of the matrix is two whole numbers of one bit a row, so a step costs a few operations on them."""
    if len(a) < len(b):
        a, b = b, a
    n = len(b)
    if not n:
        return len(a)
    places: dict = {}
    for k, t in enumerate(b):
        places.setdefault(t, []).append(k)
    rows = {}
    for t, at in places.items():
        raw = bytearray(n // 8 + 1)
        for k in at:
            raw[k >> 3] |= 1 << (k & 7)
        rows[t] = int.from_bytes(raw, "little")
    every, last = (1 << n) - 1, 1 << (n - 1)
    # where the column rises and falls from one row to the next
    up, down, distance = every, 0, n
    for t in a:
        same = rows.get(t, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | (every & ~(diagonal | up))
        right_down = up & diagonal
        distance += (right_up & last > 0) - (right_down & last > 0)
        right_up = (right_up << 1 | 1) & every
        right_down = right_down << 1 & every
        up = right_down | (every & ~(diagonal | right_up))
        down = right_up & diagonal
    return distance


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_distance(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="Int32")


def array_distance(a: Column, b: Column) -> Column:
    """Edit distance between two string arrays, or two whole strings in characters."""
    bounded()
    return _distance(a, b)


@F.pandas_udf(T.IntegerType())
def _token_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_distance(x.split(" ") if x else [], y.split(" ") if y else []) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="Int32")


def token_distance(a: Column, b: Column) -> Column:
    """Edit distance between two arrays of tokens.  Tokens are not empty and hold no space: a row goes to Python as two strings, not as an object a token."""
    bounded()
    return _token_distance(F.array_join(a, " "), F.array_join(b, " "))


@F.pandas_udf(T.StructType([T.StructField("both", T.LongType()), T.StructField("either", T.LongType())]))
def _overlap(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    out = []
    for x, y in zip(a, b, strict=True):
        p, q = (Counter(t.split(" ")) if t else Counter() for t in (x, y))
        both = (p & q).total()
        out.append((both, p.total() + q.total() - both))
    return pd.DataFrame(out, columns=["both", "either"])


def multiset_overlap(a: Column, b: Column) -> Column:
    """(both, either): how many tokens two arrays share and have together, repeats counted.  Tokens hold no space.

    Both arrays lie in one row, so nothing is shuffled.
    """
    bounded()
    return _overlap(F.array_join(a, " "), F.array_join(b, " "))


#: runs of more characters that are all rare are left to the matcher itself, which meets few places for each of them
LONGEST_RUN = 32


def _alike(a: str, i: int, b: str, j: int, most: int, step: int) -> int:
    """How many characters from (i, j) on are equal, ``most`` at most; with step -1 those before (i, j)."""
    n, width = 0, 16
    while n < most:
        width = min(width, most - n)
        x, y = (i + n, j + n) if step > 0 else (i - n - width, j - n - width)
        if a[x : x + width] == b[y : y + width]:
            n, width = n + width, width * 2
        elif width == 1:
            break
        else:
            most = min(most, n + width)
            width = max(width // 4, 1)
    return n


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _matched_by_table(a: str, b: str) -> int:
    return sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())


def matched(a: str, b: str) -> int:
    """Characters in SequenceMatcher's matching blocks, exactly, without its table of all places of a character.

    The matcher takes the longest run of characters that are rare in b, of equally long ones the first in a, then in
    b, widens it by equal characters, and goes on left and right of it.  Runs of k rare characters are looked for with
    k falling: what was not found between two ranges is not between parts of them, so a place is tried once a length.
    """
    if len(b) < 200 or not a:
        return _matched_by_table(a, b)
    codes, others = _codes(a, b)
    counts = np.bincount(others, minlength=int(codes.max()) + 1)
    rare = (counts > 0) & (counts <= len(b) // 100 + 1)
    ours, theirs = _runs(rare[codes]), _runs(rare[others])
    longest = min(max((hi - lo for lo, hi in runs), default=0) for runs in (ours, theirs))
    if longest > LONGEST_RUN:
        return _matched_by_table(a, b)
    # levels[k - 1]: the places in a of runs of k that b has too, and their places in b
    levels: list[tuple[list[int], dict[str, list[int]]]] = []
    for k in range(1, longest + 1):
        places: dict[str, list[int]] = {}
        for lo, hi in theirs:
            for j in range(lo, hi - k + 1):
                places.setdefault(b[j : j + k], []).append(j)
        at = [i for lo, hi in ours for i in range(lo, hi - k + 1) if a[i : i + k] in places]
        if not at:
            break
        levels.append((at, places))
    total = 0
    waiting = [(0, len(a), 0, len(b), len(levels))]
    while waiting:
        alo, ahi, blo, bhi, k = waiting.pop()
        i, j, size, left = alo, blo, 0, 0
        while k:
            at, places = levels[k - 1]
            for n in range(bisect_left(at, alo), len(at)):
                x = at[n]
                if x + k > ahi:
                    break
                there = places[a[x : x + k]]
                y = bisect_left(there, blo)
                if y < len(there) and there[y] + k <= bhi:
                    i, j, size = x, there[y], k
                    break
            if size:
                break
            k -= 1
        if i > alo and j > blo and a[i - 1] == b[j - 1]:
            left = _alike(a, i, b, j, min(i - alo, j - blo), -1)
        right, end, other = 0, i + size, j + size
        if end < ahi and other < bhi and a[end] == b[other]:
            right = _alike(a, end, b, other, min(ahi - end, bhi - other), 1)
        total += left + size + right
        # whatever of k characters begins left of the run was tried in vain
        if k and alo < i - left and blo < j - left:
            waiting.append((alo, i - left, blo, j - left, k - 1))
        if size + right and end + right < ahi and other + right < bhi:
            waiting.append((end + right, ahi, other + right, bhi, k))
    return total


def matching_ratio(a: str, b: str) -> float:
    """SequenceMatcher(None, a, b).ratio() of two texts."""
    return 1.0 if a == b else 2.0 * matched(a, b) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([matching_ratio(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


def matcher_ratio(a: Column, b: Column) -> Column:
    """Matching blocks' share of both strings, with the matcher's rule for frequent characters of long strings."""
    bounded()
    return _ratio(a, b)
