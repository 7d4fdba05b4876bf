"""Regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over the statistics; its covariance is shrunk towards the pooled
one and that towards a multiple of the identity.  The score is the logistic of the
difference of log densities plus the log prior odds; the Mahalanobis distances come from
Cholesky factors computed once on the driver and sent with the task.

Defined results: a null text is an empty one; every row gets a score, repeated rows equal
ones; an empty table gives an empty result; other columns pass, ``score`` and
``predicted`` are replaced.  Labels of null value or of null id teach nothing; with
labels of one class only, or none, every score is that class's value, or 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .textkit import Texts, group_sizes, per_part, repeated_lines, words_in_repeats

_CODES = np.arange(256)
_HEAD = (_CODES & 0xC0) != 0x80
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 0xC0)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_STOP = np.isin(_CODES, list(b".,;:?'\"()-"))
_ODD = (_CODES > 32) & (_CODES < 127) & ~_LETTER & ~_DIGIT & ~_STOP

FEATURES = ["log_words", "word_length", "letters", "upper", "capitalised", "digits", "stops", "odd", "odd_words", "line_words", "dup_lines", "repeats", "again", "distinct", "single"]


def features(t: Texts) -> np.ndarray:
    """One row of FEATURES per text: logarithms of counts, square roots of shares; zeros for no words."""
    n = t.n_words.astype(float)
    words, head = np.maximum(n, 1), t.count(_HEAD[t.data] & ~t.is_space)
    chars = np.maximum(head, 1).astype(float)
    share = lambda flags, of: np.sqrt(np.minimum(t.count(flags) / of, 4))
    in_words = lambda flags: np.sqrt(per_part(flags, t.word_offset) / words)
    size = (t.word_end - t.word_start) if len(t.word_start) else np.zeros(0, np.int64)
    odd = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(_ODD[t.data], out=odd[1:])
    h = t.word_hash if len(size) else np.zeros(0, np.uint64)
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (t.word_doc[1:] == t.word_doc[:-1])
    order, first, count = group_sizes(t.word_doc, h) if len(h) else (size, size, size)
    distinct = np.bincount(t.word_doc[order[first]], minlength=t.n) if len(h) else np.zeros(t.n)
    lines = t.count(t.data == 10) + 1
    out = [
        np.log1p(n),
        np.log(np.maximum(head / words, 0.5)),
        share(_LETTER[t.data], chars),
        share(_UPPER[t.data], chars),
        in_words(_UPPER[t.data[t.word_start]]) if len(size) else np.zeros(t.n),
        share(_DIGIT[t.data], chars),
        share(_STOP[t.data], chars),
        share(_ODD[t.data], chars),
        in_words(odd[t.word_end] > odd[t.word_start]) if len(size) else np.zeros(t.n),
        np.log1p(n / lines),
        np.sqrt(repeated_lines(t) / np.maximum(lines, 1)),
        np.sqrt(words_in_repeats(t, 8) / words),
        in_words(same),
        np.log(np.maximum(distinct, 1)) - 0.9 * np.log(words),
        in_words(size == 1),
    ]
    return np.stack(out, 1)


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): mean, inverse Cholesky factor of the shrunk covariance, log of its determinant; and the log prior odds."""

    mean: tuple[np.ndarray, ...]
    whiten: tuple[np.ndarray, ...]
    log_det: tuple[float, ...]
    log_odds: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        log_density = []
        for mean, whiten, log_det in zip(self.mean, self.whiten, self.log_det, strict=True):
            z = (x - mean) @ whiten.T
            log_density.append(-0.5 * ((z * z).sum(1) + log_det))
        odds = np.clip(log_density[1] - log_density[0] + self.log_odds, -40, 40)
        return 1 / (1 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, towards_pooled: float = 0.2, towards_identity: float = 0.02) -> Discriminant:
    """The discriminant of rows x with classes y (0 or 1)."""
    n = [int((y == c).sum()) for c in (0, 1)]
    if min(n) < 2:
        return Discriminant((), (), (), 0.0, 0.5 if n[0] == n[1] else float(n[1] > n[0]))
    mean = [x[y == c].mean(0) for c in (0, 1)]
    cov = [np.cov(x[y == c], rowvar=False, bias=True) for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    whiten, log_det = [], []
    for c in (0, 1):
        s = (1 - towards_pooled) * cov[c] + towards_pooled * pooled
        ridge = np.diag(np.maximum(np.diag(pooled), 1e-4))
        root = np.linalg.cholesky((1 - towards_identity) * s + towards_identity * ridge)
        whiten.append(np.linalg.inv(root))
        log_det.append(2 * float(np.log(np.diag(root)).sum()))
    return Discriminant(tuple(mean), tuple(whiten), tuple(log_det), float(np.log(n[1] / n[0])))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and classes of at most ``max_rows`` labelled documents, those of least hash of the id.

    Only the chosen ids and labels are collected before the texts are read, so the scan
    keeps none but those rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y"))
    chosen = known.groupBy("__id").agg(F.max("__y").alias("__y")).orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select("__id", "__y", text)
    wide = store.append_text_columns(rows, text, lambda t: [*features(t).T], [(f, T.DoubleType()) for f in FEATURES]).drop(text)
    # rows of equal id count once, so that what is gathered stays within max_rows
    once = wide.groupBy("__id", "__y").agg(F.min(F.struct(*FEATURES)).alias("__f")).select("__id", "__y", "__f.*")
    found = once.toPandas().sort_values("__id")
    return found[FEATURES].to_numpy(float), found["__y"].to_numpy()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000) -> Discriminant:
    """Fit on at most ``max_rows`` of the labelled documents (a bound of the driver's memory)."""
    return fit(*training_rows(docs, labels, id_col, text, label, max_rows))


def score(docs: DataFrame, model: Discriminant, text: str = "text") -> DataFrame:
    """docs with score (double) and predicted (1 from 0.5 on)."""

    def compute(t: Texts) -> list[np.ndarray]:
        s = model.score(features(t))
        return [s, (s >= 0.5).astype(np.int32)]

    return store.append_text_columns(docs, text, compute, [("score", T.DoubleType()), ("predicted", T.IntegerType())])
