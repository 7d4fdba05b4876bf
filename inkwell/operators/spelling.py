"""Correction of rare words by the corpus's own frequent words, over an index of deletions.

A word is *known* if it occurs ``known`` times or more in the corpus.  A word that is rare
in its text (once, and no stop word) and not known is replaced by the known word nearest to
it: the least edit distance (insertions, deletions, substitutions and swaps of neighbours),
then the most frequent, then the first by code point.

Two words within a distance share what is left of each after so many deletions at most, so
known and rare words are joined on these remains, not compared all with all, one deletion
first and two for what one did not find; pairs that meet are measured exactly.  Only rare, unknown words take part, and those occur less than
``known`` times, so no word of the joins is hot.  Words, remains and pairs are worked at a batch at a time; Spark counts, joins and groups them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.scratch import kept
from .batches import bounded
from .filters import STOPWORDS
from .matching import among

KNOWN = 20
#: words of fewer characters may differ by one edit only; shorter ones than LEAST are left alone, and so are those longer than LONGEST
TWO_EDITS, LEAST, LONGEST = 7, 4, 32
#: bits that are sent to all tasks, a power of two: each stands for the hashes of equal last bits, set if a known word's remain has one
SIEVE = 1 << 27
#: known words that are sent to all tasks at most, the most frequent ones; distinct words that a task counts before it hands them on; pairs measured together
COMMON, COUNTED, MEASURED = 200_000, 500_000, 100_000
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _rare(numbered: Column, most: int) -> Column:
    """Of an array of (word, at) those whose word occurs ``most`` times at most in it and is no stop word, sorted."""

    def rare(s: Column) -> Column:
        def short(w: Column, i: Column) -> Column:
            # the run of equal words that holds place i is longer than ``most`` if any two of it lie so far apart
            side = lambda k: (F.get(s, i + k) if k else w)["word"]
            other = [F.coalesce(side(-d) != side(most - d), F.lit(True)) for d in range(most + 1)]
            return reduce(and_, other) & ~w["word"].isin(STOPWORDS)

        return F.filter(s, short)

    # bound to a name, the sorted words are computed once a text, not once a word
    return T.once(F.sort_array(numbered), rare)


def _numbered(words: Column) -> Column:
    return F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))


def rare_words(words: Column, most: int = 1) -> Column:
    """The distinct words of an array that occur ``most`` times at most in it and are no stop words, sorted."""
    return F.array_distinct(F.transform(_rare(_numbered(words), most), lambda x: x["word"]))


def _words(low: str) -> list[str]:
    """All _WORD of a text."""
    # most that lies between white space, commas and stops is a word, which costs less to see than to search
    out = low.replace(",", " ").replace(".", " ").split()
    if "".join(out).isalnum():
        return out
    return [w for piece in out for w in ((piece,) if piece.isalnum() else _WORD.findall(piece))]


def _matched(text: str) -> Iterator[tuple[str, re.Match]]:
    """The words of a text in lower case, each with the piece of the text that it lies in."""
    own, low = list(_WORD.finditer(text)), _words(text.lower())
    if len(own) == len(low):
        return zip(low, own, strict=True)
    # a letter whose lower case is no letter alone cuts its word: such texts go word by word
    return ((w, m) for m in own for w in _words(m[0].lower()))


def _rare_places(text: str, most: int, common: frozenset[str]) -> list[tuple[str, int | None]]:
    """(word, from) of the words that occur ``most`` times at most in a text, may have corrections and are not common, in order."""
    low = text.lower()
    words = [w for w in _words(low) if w not in common and LEAST <= len(w) <= LONGEST]
    asked = {w for w, n in Counter(words).items() if n <= most}.difference(STOPWORDS)
    if len(low) != len(text):
        return [(w, m.start() if m[0].lower() == w else None) for w, m in _matched(text) if w in asked]
    out, end = [], 0
    for w in words:
        if w in asked:
            # all before it are placed, so it is where it stands next as a whole
            at = low.find(w, end)
            while _inner(low, at - 1) or _inner(low, at + len(w)):
                at = low.find(w, at + 1)
            end = at + len(w)
            out.append((w, at if text[at:end].lower() == w else None))
    return out


def _inner(text: str, at: int) -> bool:
    """Whether a character of a word stands at a place."""
    return 0 <= at < len(text) and (text[at] == "_" or text[at].isalnum())


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all words of the texts; a task hands on its own sums, COUNTED words or a batch at a time."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(_words(t.lower()) if t else ())
            if len(seen) >= COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
                seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return docs.select(text).mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rare_places(docs: DataFrame, text: str, most: int, frequent: DataFrame) -> DataFrame:
    """(__row, word, at) of a text's words that occur ``most`` times at most in it, may have corrections and are not frequent (word, n).

    ``at`` is where the word begins, counted from 0, null where the piece there in lower case is not the word.
    """
    spark = docs.sparkSession
    # most words are one of the most frequent: they go before they leave Python; the join drops the other known ones
    first = frequent.orderBy(F.desc("n"), "word").limit(COMMON).select("word").toArrow()["word"].to_pylist()
    common = spark.sparkContext.broadcast(frozenset(first))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, w, at) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t for w, at in _rare_places(t, most, common.value)]
            rows, words, places = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.string()), pa.array(places, pa.int32())], ["__row", "word", "at"])

    rare = docs.select("__row", text).mapInArrow(placed, "__row long, word string, at int")
    return among(rare, frequent.select("word"), "word", how="left_anti")


def _put(text: str, at: Sequence[int], new: Sequence[str]) -> str:
    out, last = [], 0
    for a, n in zip(at, new, strict=True):
        out += (text[last:a], n)
        last = _WORD.match(text, a).end()
    return "".join((*out, text[last:]))


def replaced(text: Column, places: Column, new: Column) -> Column:
    """The text with words replaced: ``places`` are where they begin, ascending, ``new`` their corrections; nulls are none."""

    @F.pandas_udf("string")
    def spelt(texts: pd.Series, at: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or a is None else _put(t, a, w) for t, a, w in zip(texts, at, words, strict=True)], dtype=object)

    return spelt(text, places, new)


def edits(word: Column) -> Column:
    """How many edits a word may be away from its correction."""
    size = F.length(word)
    return F.when((size < LEAST) | (size > LONGEST), 0).when(size < TWO_EDITS, 1).otherwise(2)


def _hashed(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the characters along the last axis."""
    value = np.full(codes.shape[:-1], codes.shape[-1], np.uint64)
    for k in range(codes.shape[-1]):
        value = (value ^ codes[..., k]) * _BASE
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of character codes."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


def _sieve(hashes: DataFrame, bits: int) -> np.ndarray:
    """Of so many bits those that the hashes (rest) set, in bytes; Spark makes them in words of 64, so what comes here has a fixed size."""
    at = F.col("rest").bitwiseAND(bits - 1)
    word = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    rows = hashes.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(word).alias("word")).toArrow()
    out = np.zeros(max(bits // 64, 1), np.int64)
    out[rows["at"].to_numpy()] = rows["word"].to_numpy()
    return out.view(np.uint8)


def _passes(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Whether a hash's bit is set."""
    at = hashes & (8 * len(sieve) - 1)
    return (sieve[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) > 0


def _flat_remains(words: Sequence[str], most: int, sieve: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of what is left after 0 to ``most`` deletions, never more than edits() of the word, with its word's place: many words of a length at once."""
    for size, at in _by_key(len(w) for w in words).items():
        if not LEAST <= size <= LONGEST:
            continue
        kinds = [np.array(list(combinations(range(size), size - d))) for d in range(min(most, 1 if size < TWO_EDITS else 2) + 1)]
        step = max(1, 1_000_000 // (len(kinds[-1]) * size))
        for lo in range(0, len(at), step):
            some = np.array(at[lo : lo + step])
            codes = _codes([words[k] for k in some]).astype(np.uint64)
            left = np.concatenate([_hashed(codes[:, kind]) for kind in kinds], axis=1)
            passed = np.ones(left.shape, bool) if sieve is None else _passes(left, sieve)
            yield np.repeat(some, passed.sum(axis=1)), left[passed]


def _remains(words: Sequence[str], most: int, sieve: np.ndarray | None = None) -> list[np.ndarray]:
    """_flat_remains() by word."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
    for at, left in _flat_remains(words, most, sieve):
        for row in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1):
            if len(row):
                out[at[row[0]]] = left[row]
    return out


def _by_key(keys: Iterable[Hashable]) -> dict[Hashable, list[int]]:
    """The places of each key."""
    out: dict[Hashable, list[int]] = {}
    for k, key in enumerate(keys):
        out.setdefault(key, []).append(k)
    return out


def remains(words: DataFrame, most: int = 2, sieve: Broadcast | None = None) -> DataFrame:
    """The rows of a table with hashes (rest) of what is left of the first column, a word, after at most ``most`` and edits() deletions, itself included.

    With a sieve it is those that pass.  A known word that is shorter than a rare one may need
    fewer deletions than the edits between them, never more than its own edits(): so both sides
    go by their own length.  What is left twice of a word may be there twice.
    """

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rest in _flat_remains(batch.column(0).to_pylist(), most, sieve and sieve.value):
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in batch.columns), pa.array(rest)], [*batch.schema.names, "rest"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    return words.mapInArrow(left, f"{schema}, rest long")


def distance(a: str, b: str, most: int) -> int:
    """Edits between two words, swaps of neighbours among them, or most + 1 if they are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    seen: dict[str, int] = {}
    rows = {-1: [len(a) + len(b)] * (len(b) + 2), 0: [len(a) + len(b), *range(len(b) + 1)]}
    for i, x in enumerate(a, 1):
        row = [len(a) + len(b), i]
        match = 0
        for j, y in enumerate(b, 1):
            up, left = seen.get(y, 0), match
            if x == y:
                match = j
            swap = rows[up - 1][left] + (i - up - 1) + 1 + (j - left - 1) if up and left else len(a) + len(b)
            row.append(min(rows[i - 1][j] + (x != y), row[j] + 1, rows[i - 1][j + 1] + 1, swap))
        seen[x] = i
        rows[i] = row
    return min(rows[len(a)][len(b) + 1], most + 1)


def near_distances(words: Sequence[str], others: Sequence[str]) -> np.ndarray:
    """distance() of every two words, 3 where it is above 2: a cell of the tables of all pairs of equal lengths at a time.

    Two edits reach no further than two places from the diagonal, and a swap no further than over one character
    that is left out or put in between.
    """
    out = np.full(len(words), 3, np.uint8)
    sizes = np.array([np.fromiter(map(len, side), np.int64, len(side)) for side in (words, others)])
    order = np.lexsort(sizes)
    for at in np.split(order, np.flatnonzero(np.diff(sizes[:, order]).any(axis=0)) + 1):
        n, m = sizes[:, at[0]].tolist() if len(at) else (0, 9)
        if abs(n - m) > 2:
            continue
        a, b = (np.ascontiguousarray(_codes([side[k] for k in at]).T) if side[at[0]] else None for side in (words, others))
        far = np.full(len(at), 9, np.uint8)
        cells: dict[tuple[int, int], np.ndarray] = {}
        for i in range(n + 1):
            for j in range(max(0, i - 2), min(m, i + 2) + 1):
                if not i or not j:
                    cells[i, j] = np.full(len(at), i + j, np.uint8)
                    continue
                best = np.minimum(cells.get((i - 1, j), far), cells.get((i, j - 1), far)) + np.uint8(1)
                best = np.minimum(best, cells[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                for p, r in ((2, 2), (3, 2), (2, 3)):
                    if i >= p and j >= r and (i - p, j - r) in cells:
                        swapped = (a[i - 1] == b[j - r]) & (a[i - p] == b[j - 1])
                        best = np.where(swapped, np.minimum(best, cells[i - p, j - r] + np.uint8(p + r - 3)), best)
                cells[i, j] = best
            for j in range(m + 1):
                cells.pop((i - 3, j), None)
        out[at] = np.minimum(cells[n, m], 3)
    return out


def _nearest(rare: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """(word, correction, edits): the best of the known words (correction, n) within ``most`` edits of each rare word (word)."""
    # remains go as hashes, which take less room; words that meet by chance are measured apart
    known = kept(remains(known.select("correction", "n"), most), "known-remains")
    # most remains of rare words are no known word's: they go before they leave Python; the join drops those that pass by chance
    sieve = rare.sparkSession.sparkContext.broadcast(_sieve(known, SIEVE))
    allowed = F.least(edits(F.col("word")), F.lit(most))
    met = remains(rare.select("word"), most, sieve).join(known, "rest").where((F.col("word") != F.col("correction")) & (F.abs(F.length("word") - F.length("correction")) <= allowed))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in _together(batches, MEASURED):
            far = pa.array(near_distances(pairs["word"].to_pylist(), pairs["correction"].to_pylist()).astype(np.int32))
            pairs = pairs.append_column("edits", far)
            yield from pairs.filter(np.asarray(far) <= np.asarray(pairs["allowed"])).drop_columns("allowed").to_batches()

    # two words may meet more than once, which changes no least
    near = met.select("word", "correction", "n", allowed.alias("allowed")).mapInArrow(measured, "word string, correction string, n long, edits int")
    best = near.groupBy("word").agg(F.min(F.struct("edits", (-F.col("n")).alias("below"), "correction")).alias("b"))
    return best.select("word", "b.correction", "b.edits")


def _together(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined to tables of so many rows and a batch at most: what is done by arrays costs a call, however short they are."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.num_rows for b in some) >= rows:
            yield pa.Table.from_batches(some)
            some = []
    if some:
        yield pa.Table.from_batches(some)


def corrections(rare: DataFrame, frequent: DataFrame) -> DataFrame:
    """(word, correction, edits) of rare words (word) by frequent ones (word, n); those without one near are left out.

    Words of either side are counted once; null words match nothing.  Only words that no
    known word is one edit away from are looked up by two deletions, of which there are many more.
    """
    bounded(rare.sparkSession)
    known = frequent.where("word IS NOT NULL").select(F.col("word").alias("correction"), "n")
    asked = kept(rare.where(F.col("word").isNotNull() & (edits(F.col("word")) > 0)).select("word").distinct(), "asked")
    one = kept(_nearest(asked, known, 1), "one-edit")
    rest = asked.where(edits(F.col("word")) > 1).join(one, "word", "left_anti")
    return one.unionByName(_nearest(rest, known, 2))


def corrected(docs: DataFrame, text: str = "text", known: int = KNOWN, most: int = 1, count: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(docs with rare, unknown words of the text corrected, the corrections made: word, correction, edits).

    A replaced word is in lower case, as the known words are.  A null text stays null, an empty
    one empty; rows of equal or null id are rows like others; other columns pass.  ``count``
    names a further column: how many words of the text were replaced, null of a null text.
    """
    # a number of its own for every row, to find it again
    bounded(docs.sparkSession)
    numbered = kept(docs.withColumn("__row", F.monotonically_increasing_id()), "texts")
    counts = kept(word_counts(numbered, text), "words")
    frequent = counts.where(F.col("n") >= known)
    rare = kept(rare_places(numbered, text, most, frequent), "rare-words")
    found = kept(corrections(rare.select("word"), frequent.where(edits(F.col("word")) > 0)), "corrections")
    # a text's own corrections: never more than its words
    of_row = rare.where("at IS NOT NULL").join(found, "word").groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("at", "correction"))).alias("__new"))
    joined = numbered.join(of_row, "__row", "left")
    spelt = replaced(F.col(text), F.col("__new.at"), F.col("__new.correction"))
    made = [] if count is None else [F.when(F.col(text).isNotNull(), F.coalesce(F.size("__new"), F.lit(0))).cast("long").alias(count)]
    return joined.select(*(spelt.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns), *made), found


def useful(found: DataFrame, logged: DataFrame | None = None) -> DataFrame:
    """(old, new) of corrections that are useful and not in the log (old, new) yet."""
    from .filters import useful_replacement

    pairs = found.select(F.col("word").alias("old"), F.col("correction").alias("new")).where(useful_replacement(F.col("old"), F.col("new")))
    return pairs if logged is None else pairs.join(logged.select("old", "new"), ["old", "new"], "left_anti")
