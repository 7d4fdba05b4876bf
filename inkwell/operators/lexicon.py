"""Canonical spelling by a lexicon: whole words and phrases, without case."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded

#: terms, and characters of all of them, that travel with a task at most
MOST_TERMS, MOST_CHARS = 2_000_000, 64_000_000


def small(text: str) -> str:
    """Lower case that keeps every character's place: one whose small letter is longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _in_word(c: str) -> bool:
    return c == "_" or c.isalnum()


class Speller:
    """A lexicon as one automaton: all its terms are found in one pass over a text."""

    def __init__(self, terms: Iterable[str]) -> None:
        self.terms = list(terms)
        self.automaton = ahocorasick.Automaton()
        for term in self.terms:
            low = small(term)
            # the first of terms that differ by case wins
            if low and low not in self.automaton:
                self.automaton.add_word(low, (len(low), term))
        if len(self.automaton):
            self.automaton.make_automaton()

    def found(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(from, to, term) of the whole-word occurrences, from left to right, the longest of those that begin together, none over another."""
        if not len(self.automaton):
            return
        hits: dict[int, tuple[int, str]] = {}
        for last, (size, term) in self.automaton.iter(small(text)):
            lo, hi = last - size + 1, last + 1
            within = (lo > 0 and _in_word(text[lo - 1])) or (hi < len(text) and _in_word(text[hi]))
            if not within and (lo not in hits or hits[lo][0] < hi):
                hits[lo] = (hi, term)
        at = 0
        for lo in sorted(hits):
            if lo >= at:
                at, term = hits[lo]
                yield lo, at, term

    def spelt(self, text: str) -> str:
        out, at = [], 0
        for lo, hi, term in self.found(text):
            out += (text[at:lo], term)
            at = hi
        return "".join((*out, text[at:])) if out else text

    def __reduce__(self):
        # the automaton is built anew where it arrives
        return Speller, (self.terms,)


def canonical_case(docs: DataFrame, terms: Iterable[str] | DataFrame, text: str = "text") -> DataFrame:
    """docs with each whole-word occurrence of a term, whatever its case, spelt as the lexicon does.

    The lexicon is a list or a table whose first column is the terms.  Of terms that begin
    together the longest counts, of terms that differ by case the first (of a table, the least
    by code point).  It travels with every task, so more than MOST_TERMS terms or MOST_CHARS
    characters are refused.  A text is read once, however many terms there are.  Null and
    empty terms are none; a null text stays null.
    """
    if isinstance(terms, DataFrame):
        name = F.col(f"`{terms.columns[0]}`").cast("string")
        table = terms.select(name.alias("term")).where("term <> ''").distinct()
        size = table.agg(F.count("term").alias("n"), F.coalesce(F.sum(F.length("term")), F.lit(0)).alias("chars")).first()
        if size["n"] > MOST_TERMS or size["chars"] > MOST_CHARS:
            raise ValueError(f"a lexicon of {size['n']} terms and {size['chars']} characters is too large to travel with a task")
        known = sorted(r["term"] for r in table.collect())
    else:
        known = [t for t in terms if t]
        if len(known) > MOST_TERMS or sum(map(len, known)) > MOST_CHARS:
            raise ValueError("the lexicon is too large to travel with a task")
    if not known:
        return docs
    bounded(docs.sparkSession)
    lexicon = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("string")
    def spell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        speller = Speller(lexicon.value)
        for texts in batches:
            yield texts.map(lambda t: t if t is None else speller.spelt(t))

    return docs.withColumn(text, spell(F.col(text)))
