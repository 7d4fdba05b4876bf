"""Passages and the spans of documents most like them: a similarity join over an index of shared runs of characters.

Of every document some q-grams are chosen by winnowing: the least hash in every window of
``WINDOW`` of them, over the cleaned text of all sentences in a row.  All q-grams of a
passage are looked up among them, so a passage meets every place that shares a run of
``SEED`` characters or more with it.  Around these places the best span of one to four
sentences is found exactly, as best_span() does, with lengths and longest common
subsequences as bounds.  A sentence that lies in a passage is found by its first
characters in the same way.

Spans may be like a passage and share no such run, so then all spans of all documents go
against all passages, in chunks of documents and blocks of passages.  What the index has
found is where a passage begins: a span is only compared if its bounds reach that.

Passages, grams and hits are tables that Spark joins; nothing of them is collected.  A hit
costs the text around it, and equal texts around hits are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS_CHARS
from ..sources.scratch import kept
from .batches import bounded
from .consensus import QUOTES, best_range, clean, ratio
from .spans import Spans, candidates

GRAM, WINDOW = 12, 13
SEED = GRAM + WINDOW - 1
#: rows of keys that are sent to all tasks to look rows up by; more are joined by a shuffle
SENT = 1_000_000
#: characters of a chunk of documents; passages of a block
CHUNK, ASKED = 1_000_000, 1000
_UNEVEN = WS_CHARS.replace(" ", "")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: str, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` characters, another for every size."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(codes) - size + 1, 0)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = value * _BASE + codes[k : k + n]
    value ^= value >> np.uint64(29) ^ np.uint64(size)
    return value * np.uint64(0xBF58476D1CE4E5B9) ^ value >> np.uint64(32)


def _sliding(least, values: np.ndarray, width: int) -> np.ndarray:
    """least (or most) of every ``width`` values in a row, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = least(values[: len(values) - step], values[step:])
        done += step
    return values


def winnowed(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the hashes that are the least of some window; every window has one."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.zeros(0, np.intp)
    least = _sliding(np.minimum, hashes, window)
    padded = np.concatenate((np.full(window - 1, least[0]), least, np.full(window - 1, least[-1])))
    return np.flatnonzero(_sliding(np.maximum, padded, window) == hashes)


def cleaned(sentences: Sequence[str]) -> list[str]:
    """clean() of every sentence in lower case, all in one go."""
    if any("\0" in s for s in sentences):
        return [clean(s.lower()) for s in sentences]
    text = _plain("\0".join(sentences).lower())
    return [p.strip() for p in text.split("\0")] if sentences else []


def _plain(text: str) -> str:
    """clean() of a text, which is not gone through again where all its white space is single spaces."""
    even = "  " not in text and not any(c in text for c in _UNEVEN)
    for old, new in QUOTES:
        text = text.replace(old, new)
    return text if even else clean(text)


def _document_keys(sentences: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, places, last keys, sentences): a document's chosen grams, and for each sentence its first and last gram and a hash of all of it, which is 0 for the others.

    A sentence shorter than a gram is its own first and last.
    """
    pieces = cleaned(sentences)
    filled = [k for k, p in enumerate(pieces) if p]
    hashes = gram_hashes(" ".join(pieces[k] for k in filled))
    sizes = np.array([len(pieces[k]) for k in filled], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    at = winnowed(hashes)
    # a gram belongs to the sentence it begins in, the space behind a sentence included
    within = np.searchsorted(begins, at, side="right") - 1
    whole, short = np.flatnonzero(sizes >= GRAM), np.flatnonzero(sizes < GRAM)
    brief = np.array([_short(pieces[filled[k]]) for k in short.tolist()], np.uint64)
    last = hashes[begins[whole] + sizes[whole] - GRAM]
    order = np.concatenate((whole, short)).astype(np.intp)
    sent = np.array([xxhash.xxh3_64_intdigest(pieces[filled[k]]) | 1 for k in order.tolist()], np.uint64)
    keys = np.concatenate((hashes[at], hashes[begins[whole]], brief)).view(np.int64)
    places = np.asarray(filled, np.int32)[np.concatenate((within, order)).astype(np.intp)]
    return keys, places, np.concatenate((hashes[at], last, brief)).view(np.int64), np.concatenate((np.zeros(len(at), np.uint64), sent)).view(np.int64)


@lru_cache(maxsize=100_000)
def _short(piece: str) -> int:
    return int(gram_hashes(piece, len(piece))[0])


def document_keys(documents: DataFrame) -> DataFrame:
    """(row, doc, place, key, last, sent) of documents (row, doc, sentences)."""
    names = ["row", "doc", "place", "key", "last", "sent"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        place, key, last, sent = (np.concatenate([r[k] for r in rows]) for k in (3, 2, 4, 5))
        sizes = [len(r[2]) for r in rows]
        row, doc = (np.repeat(np.array([r[k] for r in rows], np.int64), sizes) for k in (0, 1))
        return pa.RecordBatch.from_arrays([*map(pa.array, (row, doc, place, key, last, sent))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for row, doc, sentences in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.append((row, doc, *_document_keys(sentences.as_py() or [])))
                size += len(held[-1][2])
                if size > 200_000:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

    return documents.select("row", "doc", "sentences").mapInArrow(run, "row long, doc long, place int, key long, last long, sent long")


def passage_keys(passages: DataFrame) -> DataFrame:
    """(target, key): all grams of passages (target, phrase), and all shorter pieces, which whole sentences may be."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for target, phrase in zip(frame.target, frame.phrase, strict=True):
                wanted = clean(phrase.lower())
                keys = np.unique(np.concatenate([gram_hashes(wanted, n) for n in range(1, GRAM + 1)]))
                yield pd.DataFrame({"target": target, "key": keys.view(np.int64)})

    return passages.select("target", "phrase").mapInPandas(run, "target string, key long")


def among(df: DataFrame, keys: DataFrame, on: str, sent: int = SENT, how: str = "left_semi") -> DataFrame:
    """The rows of df whose ``on`` is in keys (with ``left_anti`` is not): the keys are sent to all tasks if they are at most ``sent``, else both sides are shuffled."""
    few = keys.limit(sent + 1).count() <= sent
    return df.join(F.broadcast(keys) if few else keys, on, how)


def _around(places: Sequence[int], n: int, most: int) -> list[tuple[int, int]]:
    """The ranges of sentences that spans of ``most`` sentences around the places reach, those that touch as one."""
    out: list[list[int]] = []
    for p in sorted(places):
        lo, hi = max(p - most + 1, 0), min(p + most, n)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        elif lo < hi:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _chunks(documents: DataFrame, include_last: bool) -> DataFrame:
    """(docs, lists) of documents (doc, sentences): some at a time, with the sentences that spans may hold."""
    schema = pa.schema([("docs", pa.list_(pa.int64())), ("lists", pa.list_(pa.list_(pa.string())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int] = []
        lists: list[list[str]] = []
        size = 0
        for batch in batches:
            for doc, sentences in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # a null sentence is no text
                usable = [s or "" for s in (sentences.as_py() or [])]
                usable = usable if include_last else usable[:-1]
                if usable:
                    docs.append(doc)
                    lists.append(usable)
                    size += sum(map(len, usable))
                if size > CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array([docs], schema.field(0).type), pa.array([lists], schema.field(1).type)], schema=schema)
                    docs, lists, size = [], [], 0
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([docs], schema.field(0).type), pa.array([lists], schema.field(1).type)], schema=schema)

    return documents.select("doc", "sentences").mapInArrow(run, "docs array<long>, lists array<array<string>>")


def better_spans(docs: Sequence[int], lists: Sequence[Sequence[str]], phrases: Sequence[str], known: Sequence[tuple | None], most: int = 4, least: float = 0.7) -> dict[int, tuple]:
    """Per place in ``phrases`` the best (-ratio, doc, from, to, span) over all spans, if it comes before the one known."""
    spans = Spans([cleaned(s) for s in lists], most)
    wanted = [clean(p.lower()) for p in phrases]
    floors = [least if k is None else max(least, -k[0]) for k in known]
    best = dict(enumerate(known))
    out: dict[int, tuple] = {}
    for t, k, bound in candidates(spans, wanted, floors):
        d, i, j = int(spans.owner[k]), int(spans.first[k]), int(spans.stop[k])
        now = best[t]
        if now is not None and (-bound, docs[d], i, j) > now[:4]:
            continue
        found = (-ratio(wanted[t], spans.span(k)), docs[d], i, j, " ".join(lists[d][i:j]))
        if -found[0] >= least and (now is None or found < now):
            best[t] = out[t] = found
            floors[t] = -found[0]
    return out


def _all_with_all(documents: DataFrame, asked: DataFrame, most: int, least: float, include_last: bool) -> DataFrame:
    """(target, b) of passages (target, phrase, b), b the best span known or null: the best of every chunk of documents that comes before it."""
    blocks = asked.groupBy(F.pmod(F.xxhash64("target"), F.lit(asked.count() // ASKED + 1)).alias("block")).agg(F.collect_list(F.struct("target", "phrase", "b")).alias("asked"))
    b = asked.schema["b"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what a task has found so far holds for its next chunks
        seen: dict[str, tuple] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                docs, lists, passages = (batch.column(k)[row].as_py() for k in range(3))
                known = [seen.get(p["target"], p["b"] and tuple(p["b"].values())) for p in passages]
                found = better_spans(docs, lists, [p["phrase"] for p in passages], known, most, least)
                for t, x in found.items():
                    seen[passages[t]["target"]] = x
                rows = [{"target": passages[t]["target"], "below": x[0], "doc": x[1], "i": x[2], "j": x[3], "span": x[4]} for t, x in found.items()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("target", pa.string()), ("below", pa.float64()), ("doc", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("span", pa.string())]))

    every = _chunks(documents, include_last).crossJoin(blocks.select("asked"))
    better = every.mapInArrow(run, "target string, below double, doc long, i int, j int, span string")
    return better.select("target", F.struct("below", "doc", "i", "j", "span").cast(b).alias("b"))


def best_matches(documents: DataFrame, passages: DataFrame, most: int = 4, least: float = 0.7, include_last: bool = False) -> DataFrame:
    """(target, span, score, part) of passages (target, phrase) over documents (doc, sentences).

    ``span`` is the best span of all documents, of equal scores the first document's and of its spans the first; it never holds
    a document's last sentence unless ``include_last``, and is null below ``least``.  ``part``
    is the first sentence that lies in the passage, exactly.  A row only where there is
    either; null phrases, null sentences and documents without sentences match nothing;
    documents of null id come last; passages of equal target are one.
    """
    spark = documents.sparkSession
    bounded(spark)
    ids = F.coalesce(F.col("doc").cast("long"), F.lit(2**63 - 1)).alias("doc")
    # a number of its own for every row: any number of documents may share an id
    documents = kept(documents.where(F.size("sentences") > 0).select(ids, "sentences", F.monotonically_increasing_id().alias("row")), "sentences")
    passages = kept(passages.where(F.col("phrase").isNotNull()).groupBy("target").agg(F.min("phrase").alias("phrase")), "passages")
    asked = kept(passage_keys(passages), "passage-keys")
    known = kept(asked.select("key").distinct(), "known-keys")
    # most keys of the documents are in no passage: they go before anything is shuffled
    met = kept(among(among(document_keys(documents), known, "key"), known.withColumnRenamed("key", "last"), "last"), "met")
    near = kept(met.where("sent = 0").join(asked, "key").groupBy("row", "target").agg(F.collect_set("place").alias("places")), "near")
    # of equal sentences the first stands for all
    begun = met.where("sent <> 0").groupBy("key", "sent").agg(F.min(F.struct("doc", "place", "row")).alias("b")).join(asked, "key").select("target", "b.row", "b.place")
    begun = kept(begun, "begun")
    whole = kept(among(documents, near.select("row").unionByName(begun.select("row")).distinct(), "row"), "near-documents")
    last = 0 if include_last else 1

    @F.udf("array<struct<at:int,run:array<string>,near:array<int>>>", useArrow=True)
    def runs(places, sentences):
        n = len(sentences) - last
        held = sorted(int(p) for p in places if p < n)
        return [(a, list(sentences[a:b]), [p - a for p in held if a <= p < b]) for a, b in _around(held, n, most)]

    around = near.join(whole, "row").select("target", "doc", F.explode(runs("places", "sentences")).alias("r")).select("target", "doc", "r.*")
    # equal texts around a passage are compared once, for the first document that holds them
    once = around.groupBy("target", "run", "near").agg(F.min(F.struct("doc", "at")).alias("first"))

    @F.pandas_udf("score double, i int, j int")
    def compared(phrases: pd.Series, found: pd.Series, near: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_range(p, list(r), most, least, list(k)) or (None, None, None) for p, r, k in zip(phrases, found, near, strict=True)], columns=["score", "i", "j"]).astype({"score": "float64", "i": "Int32", "j": "Int32"})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scored = once.join(passages, "target").repartition(parts).withColumn("b", compared("phrase", "run", "near")).where("b.score IS NOT NULL")
    span = F.array_join(F.slice("run", F.col("b.i") + 1, F.col("b.j") - F.col("b.i")), " ")
    at = F.col("first.at")
    spans = scored.select("target", F.struct((-F.col("b.score")).alias("below"), F.col("first.doc").alias("doc"), (at + F.col("b.i")).alias("i"), (at + F.col("b.j")).alias("j"), span.alias("span")).alias("b"))
    spans = kept(spans.groupBy("target").agg(F.min("b").alias("b")), "near-spans")
    spans = spans.unionByName(_all_with_all(documents, passages.join(spans, "target", "left"), most, least, include_last))

    @F.pandas_udf("boolean")
    def lies_in(part: pd.Series, phrases: pd.Series) -> pd.Series:
        return pd.Series([clean(s.lower()) in clean(p.lower()) for s, p in zip(part, phrases, strict=True)])

    held = begun.join(whole, "row").select("target", "doc", "place", F.element_at("sentences", F.col("place") + 1).alias("part"))
    single = held.groupBy("target", "part").agg(F.min(F.struct("doc", "place")).alias("first")).join(passages, "target").where(lies_in("part", "phrase"))
    first = single.select("target", F.struct(F.col("first.doc"), F.col("first.place"), "part").alias("p"))

    none_b, none_p = F.lit(None).cast(spans.schema["b"].dataType), F.lit(None).cast(first.schema["p"].dataType)
    both = spans.withColumn("p", none_p).unionByName(first.withColumn("b", none_b)).groupBy("target").agg(F.min("b").alias("b"), F.min("p").alias("p"))
    return both.select("target", F.col("b.span").alias("span"), (-F.col("b.below")).alias("score"), F.col("p.part").alias("part"))
