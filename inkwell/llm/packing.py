"""Sequence packing by Karmarkar-Karp multiway differencing.

A document longer than a sequence fills whole sequences by itself; what is left over is
gathered, some hundred pieces at a time, and dealt to near-equal windows by the
differencing method, uncut.  A window over the capacity gives up what is too much, in
pieces of at most ``finest`` tokens, and differencing goes on with the windows as they are
and those pieces; the number of windows starts at the least possible and rises while any
window passes the capacity.

Defined results: a null text is an empty one (its end id alone is packed); rows with a
null id and repeated rows are packed like others; an empty table gives an empty result;
other columns of the input are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .tokens import load

Window = tuple[int, list[int]]
#: pieces dealt out together; what a task holds back is bounded by this many sequences
BATCH = 512


def difference(sizes: list[int], windows: int, begun: list[Window] | None = None) -> list[Window]:
    """Deal the sizes to ``windows`` windows: (sum, indices) of those that got any, largest first.

    Every size begins as a partition with one filled window; ``begun`` is a partition that
    is there already.  The two partitions of greatest spread are merged, the fullest
    windows of one with the emptiest of the other, until one partition is left.
    """

    def spread(p: list[Window]) -> int:
        return p[0][0] - (p[-1][0] if len(p) == windows else 0)

    heap = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    if begun:
        there = sorted(begun, key=lambda w: (-w[0], w[1]))
        heap.append((-spread(there), len(sizes), there))
    if not heap:
        return []
    heapq.heapify(heap)
    tie = len(sizes) + 1
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        over = max(0, len(a) + len(b) - windows)
        # b's empty windows meet a's fullest; its `over` smallest go from a's emptiest on, its fullest last
        meet = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[len(a) - over :], b[::-1][:over], strict=True)]
        merged = a[: len(a) - over] + meet + b[: len(b) - over]
        merged.sort(key=lambda w: (-w[0], w[1]))
        heapq.heappush(heap, (-spread(merged), tie, merged))
        tie += 1
    return heap[0][2]


def near_equal_windows(sizes: list[int], capacity: int, begun: list[Window] | None = None) -> list[Window]:
    """difference() with the least number of windows that keeps each within the capacity."""
    begun = begun or []
    windows = max(1, len(begun), -(-(sum(sizes) + sum(s for s, _ in begun)) // capacity))
    while True:
        out = difference(sizes, windows, begun)
        if not out or out[0][0] <= capacity:
            return out
        windows += max(1, (out[0][0] - capacity) * windows // (capacity * 64))


Piece = tuple[int, int]


def cut_to_windows(sizes: list[int], capacity: int, finest: int) -> list[list[tuple[int, Piece]]]:
    """Windows of (index, (from, to)): what of which size lies in each, none over the capacity, cut only where a window was over it."""
    first = difference(sizes, max(1, -(-sum(sizes) // capacity)))
    parts: list[tuple[int, Piece]] = [(i, (0, s)) for i, s in enumerate(sizes)]
    begun: list[Window] = []
    loose: list[int] = []
    for total, members in first:
        too_much, members = total - capacity, sorted(members, key=lambda i: (-sizes[i], i))
        while too_much > 0:
            i, (lo, hi) = parts[members[0]]
            at = max(lo, hi - too_much)
            too_much -= hi - at
            total -= hi - at
            if at > lo:
                parts[members[0]] = (i, (lo, at))
            else:
                members.pop(0)
            count = -(-(hi - at) // finest)
            edges = [at + (hi - at) * k // count for k in range(count + 1)]
            for piece in zip(edges, edges[1:], strict=False):
                loose.append(len(parts))
                parts.append((i, piece))
        begun.append((total, members))
    # indices below len(loose) are loose pieces, the others parts that have their window
    moved = [(total, [len(loose) + m for m in members]) for total, members in begun]
    dealt = near_equal_windows([parts[p][1][1] - parts[p][1][0] for p in loose], capacity, moved)
    return [sorted(parts[loose[m] if m < len(loose) else m - len(loose)] for m in members) for _, members in dealt]


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.LongType(), False) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")]
)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 0, finest: int = 256, with_ids: bool = False, special_tokens: bool = True) -> DataFrame:
    """One row per piece of each document, with the sequence and the place in it.

    Each task packs its own documents, so nothing is shuffled; a task leaves at most one
    sequence badly filled.  ``with_ids`` adds the piece's ids as an array of integers;
    ``special_tokens`` is that of tokens.Encoder.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = T.StructType(SCHEMA.fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()), False)] if with_ids else []))

    def rows(batches) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer_path, special_tokens).many
        sequence = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        waiting: list[tuple] = []

        def put(doc: int | None, start: int, ids: bytes, doc_tokens: int, sequence_id: int, offset: int, total: int) -> None:
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence_id, offset, total)
            out.append((*row, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else row)

        def deal() -> None:
            nonlocal sequence
            for members in cut_to_windows([len(w[2]) // 4 for w in waiting], capacity, finest):
                total, offset = sum(hi - lo for _, (lo, hi) in members), 0
                for i, (lo, hi) in members:
                    doc, start, ids, n = waiting[i]
                    put(doc, start + lo, ids[4 * lo : 4 * hi], n, sequence, offset, total)
                    offset += hi - lo
                sequence += 1
            waiting.clear()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(c), pa.list_(pa.int32()) if k == len(SCHEMA) else pa.int64()) for k, c in enumerate(zip(*out, strict=True))]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode(v.as_py() for v in batch.column(1)), strict=True):
                ids += end
                n = len(ids) // 4
                whole = n // capacity * capacity
                for start in range(0, whole, capacity):
                    put(doc, start, ids[4 * start : 4 * (start + capacity)], n, sequence, 0, capacity)
                    sequence += 1
                if n > whole:
                    waiting.append((doc, whole, ids[4 * whole :], n))
                if len(waiting) >= BATCH:
                    deal()
                if len(out) >= 20_000:
                    yield flush()
        deal()
        if out:
            yield flush()

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(rows, schema)
