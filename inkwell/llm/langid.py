"""Language of a text: its family first, then linear support vector machines between the family's languages.

A text is the relative frequencies of its byte n-grams (two to four bytes of a word with
its edges, lower case), hashed to ``DIMS`` places and divided by the root of each place's
mean frequency.  One machine a family tells it from all others; within the family one
machine a pair of languages votes.  All are linear in frequencies, so a text of any length
is scored by one look-up an n-gram, without a vector of its own.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is
every text where nothing could be learned; with one language learned every other text is
that one.  Repeated rows get equal results; an empty table gives an empty result; other
columns pass, ``lang_pred`` and ``score`` are replaced.  Rows of null text, of null
language or without a letter teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .textkit import Texts, column_texts

BITS = 12
DIMS = 1 << BITS
WIDTHS = (2, 3, 4)
UNKNOWN = "und"
#: a machine at its margin (1 or -1) is sure by the logistic of this
STEEP = 4.0
#: texts whose vectors a task holds at once while it prepares training rows
BLOCK = 128

#: language families by ISO 639-1 code (fixed values); a language not listed is a family of its own
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "indic": "bn gu hi mr ne pa ur",
    "dravidian": "kn ml ta te",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tr tt uz",
    "finnic": "et fi",
    "semitic": "am ar he mt",
    "malayic": "id jv ms su tl",
    "chinese": "zh",
}


def family_of(lang: str) -> str:
    code = lang.replace("_", "-").split("-")[0].lower()
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), f"only {code}")


_KEPT = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KEPT[_lo:_hi] = np.arange(_lo, _hi)


def prepared(column: pa.Array) -> pa.Array:
    """Texts in lower case between two spaces; a null is an empty text."""
    edge, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    return pc.binary_join_element_wise(edge, pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), edge, space)


def grams(t: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width, the places of the n-grams and the number of them before each text (and in all).

    An n-gram holds a letter and no edge of a word inside; none reaches into the next text, as two edges stand between.
    """
    data = _KEPT[t.data]
    edge = data == 0x20
    code = data.astype(np.uint32)
    value, inside = code, np.ones(len(data), bool)
    for width in range(2, max(WIDTHS) + 1):
        n = max(len(data) - width + 1, 0)
        value = value[:n] << np.uint32(8) | code[width - 1 :]
        if width > 2:
            inside = inside[:n] & ~edge[width - 2 : width - 2 + n]
        if width in WIDTHS:
            at = np.flatnonzero(inside[:n] & ~(edge[:n] & edge[width - 1 :]))
            place = (value[at] ^ np.uint32(width)) * np.uint32(0x9E3779B1)
            yield ((place ^ place >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)).astype(np.intp), np.searchsorted(at, t.offset)


def frequencies(t: Texts) -> np.ndarray:
    """One row of DIMS relative frequencies a text."""
    counts = np.zeros((t.n, DIMS), np.float32)
    for place, before in grams(t):
        doc = np.repeat(np.arange(t.n, dtype=np.int64), np.diff(before))
        counts += np.bincount(doc * DIMS + place, minlength=t.n * DIMS).reshape(t.n, DIMS)
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


# --- machines -----------------------------------------------------------------------------


def machine(x: np.ndarray, y: np.ndarray, c: float = 50.0, rounds: int = 20, inner: int = 25) -> np.ndarray:
    """Weights, the last one the bias, of the linear machine of least ``|w|^2 / 2 + c * mean squared hinge`` of rows x, y being 1 or -1; both classes weigh the same.

    Newton steps by conjugate gradients, halved until the objective falls.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32, copy=False)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * c
    times = lambda v: (x @ v.astype(np.float32)).astype(float)
    back = lambda v: (v.astype(np.float32) @ x).astype(float)
    w, margin = np.zeros(x.shape[1]), np.zeros(len(x))
    value = lambda w, m: 0.5 * (w @ w) + (share * np.maximum(0, 1 - y * m) ** 2).sum()
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * margin)
        slope = w - 2 * back(share * slack * y)
        if np.linalg.norm(slope) < 1e-4 * max(1.0, np.linalg.norm(w)):
            break
        curve = 2 * share * (slack > 0)
        step, r = np.zeros_like(w), -slope
        p, rr = r.copy(), r @ r
        stop = rr * 1e-4
        for _ in range(inner):
            q = p + back(curve * times(p))
            alpha = rr / (p @ q)
            step += alpha * p
            r = r - alpha * q
            new = r @ r
            if new <= stop:
                break
            p, rr = r + (new / rr) * p, new
        ahead, size, now = times(step), 1.0, value(w, margin)
        while size > 1e-6 and value(w + size * step, margin + size * ahead) > now:
            size /= 2
        w, margin = w + size * step, margin + size * ahead
    return w


@dataclass(frozen=True)
class Model:
    """Languages by family, and the machines: columns of ``weights`` (DIMS x machines) and ``bias``; ``families`` machines first, then one for each of ``pairs``."""

    languages: tuple[str, ...]
    families: tuple[tuple[int, ...], ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, t: Texts) -> np.ndarray:
        """Value of every machine for every text: a look-up an n-gram."""
        sums, n = np.zeros((t.n, self.weights.shape[1])), np.zeros(t.n, np.int64)
        for place, before in grams(t):
            each = np.diff(before)
            some = np.flatnonzero(each)
            if len(some):
                sums[some] += np.add.reduceat(self.weights[place], before[some], axis=0)
            n += each
        return sums / np.maximum(n, 1)[:, None] + self.bias

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) from the machines' values: the likeliest family, in it the most votes, equal votes by likelihood."""
        sure = 1 / (1 + np.exp(-np.clip(STEEP * margins, -40, 40)))
        n = len(margins)
        if len(self.families) > 1:
            likely = sure[:, : len(self.families)]
            likely = likely / likely.sum(1, keepdims=True)
            family = likely.argmax(1)
            score = likely[np.arange(n), family]
        else:
            family, score = np.zeros(n, np.int64), np.ones(n)
        first = len(self.families) if len(self.families) > 1 else 0
        chosen = np.zeros(n, np.int64)
        for f, members in enumerate(self.families):
            at = np.flatnonzero(family == f)
            votes = np.zeros((len(at), len(members)))
            chance = np.zeros((len(at), len(members)))
            for k, (a, b) in enumerate(self.pairs):
                if a in members:
                    p = sure[at, first + k]
                    i, j = members.index(a), members.index(b)
                    votes[:, i] += p >= 0.5
                    votes[:, j] += p < 0.5
                    chance[:, i] += p
                    chance[:, j] += 1 - p
            others = max(len(members) - 1, 1)
            best = (votes + chance / (others + 1)).argmax(1) if len(members) > 1 else np.zeros(len(at), np.int64)
            chosen[at] = np.asarray(members)[best]
            if len(members) > 1:
                score[at] *= chance[np.arange(len(at)), best] / others
        return chosen, score


def fit(x: np.ndarray, langs: list[str], c: float = 50.0) -> Model:
    """The machines of rows x of relative frequencies with their languages."""
    languages = tuple(sorted(set(langs)))
    named: dict[str, list[int]] = {}
    for i, lang in enumerate(languages):
        named.setdefault(family_of(lang), []).append(i)
    families = tuple(tuple(m) for _, m in sorted(named.items()))
    pairs = tuple((a, b) for m in families for i, a in enumerate(m) for b in m[i + 1 :])
    y = np.asarray([languages.index(lang) for lang in langs], np.int64)
    scale = (1 / np.sqrt(np.maximum(x.mean(0), 1e-5))).astype(np.float32) if len(x) else np.ones(DIMS, np.float32)
    x = x * scale
    made = []
    if len(families) > 1:
        made += [machine(x, np.where(np.isin(y, m), 1.0, -1.0), c) for m in families]
    for a, b in pairs:
        of = (y == a) | (y == b)
        made.append(machine(x[of], np.where(y[of] == a, 1.0, -1.0), c))
    w = np.stack(made, 1) if made else np.zeros((DIMS + 1, 0))
    return Model(languages, families, pairs, w[:-1] * scale[:, None], w[-1])


# --- Spark --------------------------------------------------------------------------------


def _letters(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def training_rows(docs: DataFrame, text: str, lang: str, max_rows: int, max_languages: int, min_rows: int) -> tuple[np.ndarray, list[str]]:
    """Frequencies and languages of at most ``max_rows`` different rows, as many of each language as there are, those of least hash.

    Learned are the ``max_languages`` commonest languages of at least ``min_rows`` rows.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).cast("string").alias("__lang"), F.col(text).alias("__text"))
    sizes = known.groupBy("__lang").count().where(F.col("count") >= min_rows).orderBy(F.desc("count"), "__lang").limit(max_languages).collect()
    if not sizes:
        return np.zeros((0, DIMS), np.float32), []
    quota = max_rows // len(sizes)
    places = 1 << 30
    below = F.create_map(*[F.lit(v) for r in sizes for v in (r["__lang"], min(places, places * quota // r["count"]))])
    drawn = known.withColumn("__hash", F.xxhash64("__text", "__lang")).where(F.pmod("__hash", F.lit(places)) < below[F.col("__lang")])
    once = drawn.groupBy("__lang", "__hash").agg(F.first("__text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                rows = [r for _, _, t in column_texts(prepared(part.column(2))) for r in frequencies(t)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "hash", "x"])

    wide = once.select("__lang", "__hash", "__text").mapInArrow(run, "lang string, hash long, x binary")
    found = wide.orderBy("hash", "lang").limit(max_rows).toArrow().sort_by([("hash", "ascending"), ("lang", "ascending")])
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float32).reshape(-1, DIMS)
    return x, found["lang"].to_pylist()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_rows: int = 6_000, max_languages: int = 100, min_rows: int = 2) -> Model:
    """Fit on at most ``max_rows`` rows of at most ``max_languages`` languages (bounds of the driver's memory)."""
    return fit(*training_rows(docs, text, lang, max_rows, max_languages, min_rows))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1)."""
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType())]
    schema = store.appended_schema(docs, fields)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    languages = np.array([*model.languages, UNKNOWN], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            if not batch.num_rows:
                continue
            said = _letters(column) & (len(model.languages) > 0)
            at, score = np.full(batch.num_rows, len(model.languages)), np.zeros(batch.num_rows)
            if len(model.languages):
                # a part of the rows at a time: lower case makes a second copy of its texts
                step = max(1, min(batch.num_rows, int(batch.num_rows * (8 << 20) / max(column.nbytes, 1))))
                for lo in range(0, batch.num_rows, step):
                    for a, b, t in column_texts(prepared(column.slice(lo, step))):
                        at[lo + a : lo + b], score[lo + a : lo + b] = model.predict(model.margins(t))
            lang = np.where(said, languages[at], UNKNOWN)
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(np.where(said, score, 0.0))], names=schema.names)

    return docs.mapInArrow(run, schema)
