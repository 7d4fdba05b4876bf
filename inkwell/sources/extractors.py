"""The plug point for extractors that turn files of bytes (scans, PDF) into text."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of one file -> text of its pages in order
Provider = Callable[[bytes], list[str]]


def utf8_provider(content: bytes) -> list[str]:
    """The stub: content that is text already, one page."""
    return [bytes(content).decode("utf-8", "ignore")]


def extracted(files: DataFrame, provider: Provider, content: str = "content") -> DataFrame:
    """files with ``text``: every page's text followed by a line break; null where the provider fails."""

    @F.pandas_udf("string")
    def run(blobs: pd.Series) -> pd.Series:
        def one(b: bytes | None) -> str | None:
            if b is None:
                return None
            try:
                return "".join(page + "\n" for page in provider(b))
            except Exception:  # a broken file must not stop the job: its row says so by a null
                return None

        return blobs.map(one)

    return files.withColumn("text", run(F.col(content)))
