"""Unicode normal form KC, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import bounded


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    """NFKC of a text, by an Arrow UDF."""
    bounded()
    return _nfkc(text)
