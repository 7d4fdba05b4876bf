"""Plug points for what an installation brings along: sentence models, entity models, extractors, correctors.

A provider is a function of columns or rows; the defaults need nothing but Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .batches import bounded

SentenceModel = Callable[[Column], Column]
EntityModel = Callable[[Column], Column]


def split_sentences(docs: DataFrame, text: str = "text", model: SentenceModel = T.sentences) -> DataFrame:
    """docs with the array column ``sentences``."""
    return docs.withColumn("sentences", model(F.col(text)))


def titled_names(text: Column) -> Column:
    """Default entity model: distinct titles followed by a capitalised word."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?:Monsieur|Madame|M\.|Mme)[\x09-\x0D\x20]+[A-ZÉÈÀ][a-z]+"), F.lit(0)))


def splice(text: str, edits: Sequence[tuple[int, int, str]]) -> str:
    """Replace (offset, length) by a string for every edit, from right to left; of edits at one offset the last given goes first."""
    for offset, length, new in sorted(edits, key=lambda e: e[0], reverse=True):
        text = text[:offset] + new + text[offset + length :]
    return text


def corrected(docs: DataFrame, provider: Callable[[str], Sequence[tuple[int, int, str]]], text: str = "text") -> DataFrame:
    """docs with each paragraph (line) corrected by a provider's edits; a provider that fails leaves its paragraph as it is.

    ``edits`` keeps what was changed, as (old, new) in lower case.
    """
    bounded(docs.sparkSession)

    @F.pandas_udf("text string, edits array<struct<old:string,new:string>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for whole in texts:
            lines, log = [], []
            for line in (whole or "").split("\n"):
                if not line.strip():
                    continue
                try:
                    edits = list(provider(line))
                except Exception:  # a provider is foreign code: its failure must not stop the job
                    edits = []
                for offset, length, new in edits:
                    log.append((line[offset : offset + length].strip().lower(), new.strip().lower()))
                lines.append(splice(line, edits))
            rows.append(("\n".join(lines), log))
        return pd.DataFrame(rows, columns=["text", "edits"])

    return docs.withColumn("__c", run(F.col(text))).withColumn(text, F.col("__c.text")).withColumn("edits", F.col("__c.edits")).drop("__c")


def dictionary_provider(words: dict[str, str]) -> Callable[[str], list[tuple[int, int, str]]]:
    """A provider that replaces whole words by a dictionary: the offline stand-in for a spelling or grammar service."""
    import regex

    def provide(line: str) -> list[tuple[int, int, str]]:
        return [(m.start(), m.end() - m.start(), words[m[0].lower()]) for m in regex.finditer(r"[\p{L}\p{N}_]+", line) if m[0].lower() in words]

    return provide


def new_log_lines(edits: DataFrame, logged: DataFrame) -> DataFrame:
    """(old, new) pairs that are useful and not in the log yet."""
    from .filters import useful_replacement

    pairs = edits.where(useful_replacement(F.col("old"), F.col("new"))).select("old", "new").distinct()
    return pairs.join(logged.select("old", "new"), ["old", "new"], "left_anti")
