"""Near-duplicate documents by ProbMinHash of weighted word shingles.

A text is the multiset of its shingles of five words; the weight of a shingle is the
number of times that it occurs.  Similarity is the probability Jaccard of two weight
vectors, ``J_P = sum over common d of 1 / sum over e of max(v_e / v_d, w_e / w_d)``, which
is the plain Jaccard where no shingle repeats.

Signatures: every shingle starts a Poisson process of its weight as rate, whose arrivals
go to registers at random; a register keeps its first arrival, and a process ends as soon
as its next arrival cannot be the first of any register.  Two texts agree in a register
with probability J_P.  Bands of registers propose pairs and exact J_P verifies them.

Within a bucket no pairs are listed.  Every text is compared with its bucket's smallest,
beside which it is sorted, so that a task holds one of those and a batch of others; a
smallest text with many others is dealt to several tasks.  What this links is joined to
components.  Only buckets that still hold more than one component are gone through again:
there, in blocks bounded in texts and in words, texts of different components whose
signatures agree enough are verified too, where no link found before connects them.  So
components are those of all links between texts that share a bucket, whatever its size.

Defined results: equal word sequences are one text (one node, whatever its number of
copies); a text without words has no shingles and is linked to its copies only; fewer than
five words make one shingle of them all; a null text is alone in its class; rows of null
id or repeated rows get their text's class; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store
from .components import components
from .textkit import GOLDEN, MIX_A, MIX_B, U64, Texts, column_texts, group_sizes, mix

WIDTH, THRESHOLD = 5, 0.8
REGISTERS, ROWS = 128, 5
BANDS = REGISTERS // ROWS
#: a pair of J_P = 0.8 agrees in this share of registers but for a chance below 1e-6
AGREEMENT = 0.62
#: texts and words that a block, and texts that a smallest text's task, aim at
BLOCK, BLOCK_WORDS = 2048, 4_000_000


def shingles(t: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, weight) of the distinct shingles of each text."""
    key, doc, _ = t.windows(width)
    short = np.flatnonzero((t.n_words > 0) & (t.n_words < width))
    if len(short):
        acc = t.n_words[short].astype(U64) * GOLDEN
        for k in range(width - 1):
            there = t.n_words[short] > k
            acc[there] = acc[there] * MIX_A + t.word_hash[t.word_offset[short[there]] + k]
        key, doc = np.concatenate((key, mix(acc))), np.concatenate((doc, short))
    if not len(key):
        return doc, key, np.zeros(0)
    order, first, size = group_sizes(doc, key)
    return doc[order[first]], key[order[first]], size.astype(float)


def signatures(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """(n, m) registers, 16 bits each of the element that arrived first.

    A register is held as one 64-bit number: the arrival time's bits, of which the lowest
    16 give way to the element's, so that the smallest number is the first arrival's.
    """
    late = np.iinfo(np.uint64).max
    registers = np.full(n * m, late, U64)
    low, tag = U64(0xFFFF), mix(key + GOLDEN) & U64(0xFFFF)
    time, draw, step = np.zeros(len(key)), 0, 1
    alive = np.arange(len(key))
    while len(alive):
        at = np.arange(draw + 1, draw + step + 1, dtype=U64) * GOLDEN
        with np.errstate(over="ignore"):
            r = mix(key[alive][:, None] + at[None, :])
        gap = -np.log(((r >> U64(11)).astype(float) + 0.5) * 2.0**-53) / weight[alive][:, None]
        arrival = np.cumsum(gap, 1) + time[alive][:, None]
        which = (mix(r) % U64(m)).astype(np.int64) + (doc[alive] * m)[:, None]
        held = (arrival.view(U64) & ~low) | tag[alive][:, None]
        np.minimum.at(registers, which.ravel(), held.ravel())
        time[alive] = arrival[:, -1]
        last = registers.reshape(n, m).max(1)
        alive = alive[(time[alive].view(U64) & ~low) <= last[doc[alive]]]
        draw += step
        step = min(step * 2, max(1, 4_000_000 // max(1, len(alive))), 4096)
    return (registers & low).astype(np.uint16).reshape(n, m)


def probability_jaccard(ka: np.ndarray, wa: np.ndarray, kb: np.ndarray, wb: np.ndarray) -> float:
    """Exact J_P of two weight vectors with sorted keys; texts without shingles are like nothing."""
    if not len(ka) or not len(kb):
        return 0.0
    union = np.union1d(ka, kb)
    a, b = np.zeros(len(union)), np.zeros(len(union))
    a[np.searchsorted(union, ka)] = wa
    b[np.searchsorted(union, kb)] = wb
    both = (a > 0) & (b > 0)
    if not both.any():
        return 0.0
    pairs, times = np.unique(np.stack((a[both], b[both])), axis=1, return_counts=True)
    return float(sum(k / np.maximum(a / p, b / q).sum() for (p, q), k in zip(pairs.T, times, strict=True)))


def _sign(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, digest, sig, words) of every row; a null text has no digest, a text without words no sig."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sig", T.BinaryType()), T.StructField("words", T.LongType())])

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes | None] = []
            sigs: list[bytes | None] = []
            words_of: list[int] = []
            column = batch.column(2)
            for _, _, t in column_texts(column):
                words, edge = t.word_hash if len(t.word_start) else np.zeros(0, U64), t.word_offset
                digests += [hashlib.blake2b(words[edge[i] : edge[i + 1]].tobytes(), digest_size=16).digest() for i in range(t.n)]
                sig = signatures(*shingles(t), t.n)
                sigs += [s.tobytes() if k else None for s, k in zip(sig, t.n_words, strict=True)]
                words_of += t.n_words.tolist()
            null = column.is_null().to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([None if z else d for d, z in zip(digests, null, strict=True)], pa.binary()), pa.array([None if z else s for s, z in zip(sigs, null, strict=True)], pa.binary()), pa.array(words_of, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _verified(texts: DataFrame) -> DataFrame:
    """Links (a, b) between a bucket's smallest node and its others whose exact J_P reaches the threshold.

    ``texts`` is (node, centers, text): centers are the smallest nodes of the node's buckets.
    """
    each = texts.select(F.explode("centers").alias("center"), "node", "text")
    large = store.written(texts.select(F.explode("centers").alias("center")).groupBy("center").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK), "near-large-stars")
    parts = F.expr(f"(coalesce(n, 1) + {BLOCK - 1}) div {BLOCK}")
    own = F.col("node") == F.col("center")
    among = F.when(own, F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), parts)))
    dealt = each.join(large, "center", "left").select("center", F.explode(among).alias("part"), (~own).alias("other"), "node", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        center, held = None, (np.zeros(0, U64), np.zeros(0))
        for batch in batches:
            centers, nodes, other = batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(2).to_pylist()
            a: list[int] = []
            b: list[int] = []
            for lo, hi, t in column_texts(batch.column(4)):
                sets = _by_text(*shingles(t), t.n)
                i = lo
                while i < hi:
                    if not other[i]:
                        center, held = centers[i], sets[i - lo]
                        i += 1
                        continue
                    end = i
                    while end < hi and other[end] and centers[end] == center:
                        end += 1
                    if end == i:
                        raise RuntimeError("a bucket's smallest text is missing")
                    near = np.flatnonzero(_alike(held, sets[i - lo : end - lo])) + i
                    a += [center] * len(near)
                    b += [nodes[k] for k in near]
                    i = end
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.repartition("center", "part").sortWithinPartitions("center", "part", "other").mapInArrow(run, "a long, b long")


def _by_text(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    order = np.lexsort((key, doc))
    doc, key, weight = doc[order], key[order], weight[order]
    edge = np.searchsorted(doc, np.arange(n + 1))
    return [(key[edge[i] : edge[i + 1]], weight[edge[i] : edge[i + 1]]) for i in range(n)]


def _keys(id_: Column, key: Column) -> list[Column]:
    """A row's id and text hash as columns that are never null, so that equal rows meet by plain equality."""
    return [F.coalesce(id_, F.lit(0)).alias("__id"), id_.isNull().alias("__none"), key.alias("__key")]


def _texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, centers, sig, text) of the wanted nodes (node, centers), from each node's first row."""
    place = nodes.join(wanted, "node").select("node", "centers", "sig", *_keys(F.col("first.doc_id"), F.col("first.text_key")))
    place = store.written(place, "near-wanted")
    full = docs.select(*_keys(F.col("doc_id"), F.xxhash64("text")), "text")
    # by shuffle at every size: the wanted nodes are a share of all, so they outgrow a broadcast
    found = full.join(place.hint("merge"), ["__id", "__none", "__key"]).dropDuplicates(["__id", "__none", "__key"])
    return store.cut(found.select("node", "centers", "sig", "text"))


def _alike(one: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Whether exact J_P with each of the others reaches the threshold.

    Where no shingle repeats J_P is the plain Jaccard, and all others are looked up in one pass.
    """
    key, weight = one
    out = np.zeros(len(others), bool)
    if not len(key):
        return out
    simple = np.array([bool((weight == 1).all()) and len(k) > 0 and bool((w == 1).all()) for k, w in others], bool)
    at = np.flatnonzero(simple)
    if len(at):
        sizes = np.array([len(others[i][0]) for i in at])
        flat = np.concatenate([others[i][0] for i in at])
        place = np.minimum(np.searchsorted(key, flat), len(key) - 1)
        both = np.add.reduceat((key[place] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        out[at] = both >= THRESHOLD * (len(key) + sizes - both) - 1e-9
    for i in np.flatnonzero(~simple):
        out[i] = probability_jaccard(key, weight, *others[i]) >= THRESHOLD
    return out


def _cross_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) of different labels of a bucket block: a spanning forest of its pairs that verify.

    A pair counts in the first band that it shares and if its signatures agree enough.  It
    is verified exactly unless links found before connect it already, as then it would change
    no component.  So a block of many alike texts costs about a verification per text, and no
    pair leaves the task but one per join of two components.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, label, half, band = (table[c].to_numpy() for c in ("node", "label", "half", "band"))
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(node), REGISTERS)
        before = sig[:, : int(band[0]) * ROWS].reshape(len(node), -1, ROWS)
        two = bool(half.any())
        left, right = (np.flatnonzero(half == 0), np.flatnonzero(half == 1)) if two else (np.arange(len(node)),) * 2
        need = int(np.ceil(AGREEMENT * REGISTERS))
        root = np.unique(label, return_inverse=True)[1]
        sets: list[tuple[np.ndarray, np.ndarray]] = []
        for _, _, t in column_texts(table["text"].combine_chunks()):
            sets += _by_text(*shingles(t), t.n)
        links: list[tuple[int, int]] = []
        for i in left.tolist():
            near = right if two else right[right > i]
            near = near[root[near] != root[i]]
            near = near[(sig[near] == sig[i]).sum(1) >= need]
            if len(near) and before.shape[1]:
                near = near[~(before[near] == before[i]).all(2).any(1)]
            if not len(near):
                continue
            for j in near[_alike(sets[i], [sets[k] for k in near])].tolist():
                if root[i] != root[j]:
                    links.append((int(label[i]), int(label[j])))
                    root[root == root[j]] = root[i]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("key", "block").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text_key (xxhash64 of the text), class_id, class_size, kept.

    ``class_id`` is the smallest id of the class and ``kept`` marks its row; of rows that
    share that id, the one of least text hash (repeated rows are all marked: see
    ``keep_one``).
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = store.cut(_sign(narrow.select("doc_id", F.xxhash64("text").alias("text_key"), "text")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    grouped = signed.where("digest IS NOT NULL").groupBy("digest").agg(first.alias("first"), F.max("sig").alias("sig"), F.max("words").alias("words"), F.count(F.lit(1)).alias("copies"))
    nodes = store.cut(grouped.withColumn("node", F.monotonically_increasing_id()))

    bands = nodes.where("sig IS NOT NULL").select("node", "words", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"), "sig")
    member = bands.select(F.xxhash64("band", F.expr(f"substring(sig, band * {2 * ROWS} + 1, {2 * ROWS})")).alias("key"), "band", "node", "words")
    shared = store.written(member.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key", "least"), "near-buckets")
    within = store.written(member.join(shared, "key"), "near-members")
    # at most one smallest node for each band
    texts = _texts_of(within.groupBy("node").agg(F.collect_set("least").alias("centers")), nodes, narrow)
    labels = store.cut(components(store.cut(_verified(texts))))

    # buckets that hold more than one component yet
    named = within.join(labels, "node", "left").select("key", "band", "node", "words", F.coalesce("label", "node").alias("label"))
    sums = [F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("words").alias("total")]
    blocks = F.expr(f"greatest((n + {BLOCK - 1}) div {BLOCK}, (total + {BLOCK_WORDS - 1}) div {BLOCK_WORDS})")
    mixed = store.written(named.groupBy("key").agg(*sums).where("lo < hi").select("key", blocks.alias("blocks")), "near-mixed")
    mine = F.pmod(F.xxhash64("node"), "blocks")
    each = named.join(mixed, "key").withColumn("mine", mine).withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
    low, high = F.least("mine", "with"), F.greatest("mine", "with")
    dealt = each.select("key", "band", "node", "label", (low * F.col("blocks") + high).alias("block"), F.when(F.col("mine") > F.col("with"), 1).otherwise(0).alias("half"))
    more = store.cut(_cross_links(dealt.join(texts.select("node", "sig", "text"), "node")))

    classed = nodes.join(labels, "node", "left").select("digest", "first", "copies", F.coalesce("label", "node").alias("label"))
    if not more.isEmpty():
        again = components(more).withColumnRenamed("label", "__to")
        classed = classed.join(again.withColumnRenamed("node", "label"), "label", "left").select("digest", "first", "copies", F.coalesce("__to", "label").alias("label"))
    heads = classed.groupBy("label").agg(F.min("first").alias("head"), F.sum("copies").alias("class_size"))
    by_digest = classed.join(heads, "label").select("digest", "head", "class_size")
    out = signed.join(by_digest, "digest", "left")
    alone = F.col("digest").isNull()
    is_head = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & F.col("text_key").eqNullSafe(F.col("head.text_key"))
    return out.select("doc_id", "text_key", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), (alone | is_head).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, whole, of which one of each class stays; of repeated rows one."""
    kept = near_duplicates(docs, id_col, text).where("kept").select(*_keys(F.col("doc_id"), F.coalesce("text_key", F.lit(0)))).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("__row"), *_keys(F.col(f"`{id_col}`").cast("long"), F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0))))
    one = keyed.join(kept, ["__id", "__none", "__key"]).dropDuplicates(["__id", "__none", "__key"])
    return one.select(*(F.col("__row")[c].alias(c) for c in docs.columns))
