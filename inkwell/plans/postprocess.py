"""The post-processing pipeline: text to text in a fixed order, projections of texts but for the correction of rare words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, spelling
from ..operators.batches import bounded, spread

LONGEST = 1000


def steps(longest: int = LONGEST, custom: list[tuple[str, str]] | None = None) -> list[tuple[str, Callable[[Column], Column]]]:
    """(name, function) in order.  Typography joins all lines first, so line filters see sentences of long texts only."""
    return [
        ("typography", cleaning.typography),
        ("misreadings", lambda c: cleaning.misreadings(c, custom)),
        ("split_long", lambda c: cleaning.split_long(c, longest)),
        ("purge", cleaning.purge),
        ("clean", cleaning.clean),
        ("dedup", cleaning.dedup),
    ]


def postprocess(docs: DataFrame, text: str = "text", longest: int = LONGEST, custom: list[tuple[str, str]] | None = None) -> DataFrame:
    """docs with the text cleaned.  Each step is a projection of its own, so that no step's expression is computed twice."""
    bounded(docs.sparkSession)
    out = spread(docs)
    for _, step in steps(longest, custom):
        out = out.withColumn(text, step(F.col(text)))
    return out


def postprocess_full(docs: DataFrame, text: str = "text", longest: int = LONGEST, custom: list[tuple[str, str]] | None = None, known: int = spelling.KNOWN) -> tuple[DataFrame, DataFrame]:
    """(docs with the text cleaned and its rare words corrected, the corrections): all eight steps.

    Rare words are looked for in the cleaned text, as are the corpus's known words, and
    repeated lines are dropped once more after the correction, which may make lines equal.
    """
    bounded(docs.sparkSession)
    out = spread(docs)
    for name, step in steps(longest, custom):
        if name == "dedup":
            out, found = spelling.corrected(out, text, known)
        out = out.withColumn(text, step(F.col(text)))
    return out, found
