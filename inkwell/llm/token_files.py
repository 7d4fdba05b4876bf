"""Token ids as Arrow stream-format files of fixed-size-list batches.

Every file is an Arrow IPC file whose batches hold two columns, ``ids`` and ``mask``, of
fixed-size lists: row r of batch b lies at a computed place of the memory-mapped file, so
any sequence and its mask are reached without copying or scanning.  The documents of a
file follow one another through its sequences; only its last sequence is padded (mask
false).  A second, small Arrow file beside it lists its documents and their lengths.

Files are written by tasks over ranges of the document id, under names no other attempt
uses; the manifest that the job returns names the files that count, so a lost executor or
a repeated task leaves at most an unnamed file behind.

Defined results: a null text is an empty one (its end id alone is written); rows with a
null id come first, rows of equal id in order of their texts; an empty table makes an
empty manifest; other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store
from .tokens import load

MANIFEST = "part int, ids_file string, docs_file string, n_documents long, n_tokens long"
#: bytes of text that a range, and so a file, aims at
RANGE_BYTES = 64 << 20
SEQUENCES_A_BATCH = 256


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a URI or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Appends ids to one file, a batch at a time; holds no more than a batch."""

    def __init__(self, sink, length: int, dtype: np.dtype) -> None:
        self.length, self.dtype, self.held, self.n = length, dtype, [], 0
        item = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([pa.field("ids", pa.list_(pa.field("item", item, nullable=False), length), False), pa.field("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length), False)])
        self.writer = ipc.new_file(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n += len(ids)
        if self.n >= SEQUENCES_A_BATCH * self.length:
            self._write(self.n // (SEQUENCES_A_BATCH * self.length) * SEQUENCES_A_BATCH * self.length)

    def _write(self, n: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        now, rest = flat[:n], flat[n:]
        self.held, self.n = [rest], len(rest)
        step = SEQUENCES_A_BATCH * self.length
        for k in range(0, n, step):
            part = now[k : k + step]
            pad = -len(part) % self.length
            mask = np.arange(len(part) + pad) < len(part)
            ids = np.concatenate((part, np.zeros(pad, self.dtype)))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((ids, mask), self.schema, strict=True)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._write(self.n)
        self.writer.close()


def read_sequence(uri: str, index: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one sequence by random access; local files are memory-mapped, not read."""
    system, path = open_store(uri)
    source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
    batch = ipc.open_file(source).get_batch(index // SEQUENCES_A_BATCH)
    row = index % SEQUENCES_A_BATCH
    return tuple(c[row].values.to_numpy(zero_copy_only=False) for c in batch.columns)


def write(docs: DataFrame, tokenizer_path: str, out_uri: str, id_col: str = "doc_id", text: str = "text", end_id: int = 1, sequence_length: int = 1024, range_bytes: int = RANGE_BYTES, special_tokens: bool = True) -> DataFrame:
    """Write the files under ``out_uri`` and return the manifest; ``part`` ascends with the ids.

    Ids take two bytes where the vocabulary's size allows it.  Ranges are cut by id and the
    beginning of the text, so rows of null or equal id can be dealt to several tasks.
    """
    spark = docs.sparkSession
    dtype = np.dtype(np.uint16 if load(tokenizer_path, special_tokens).size <= 1 << 16 else np.uint32)
    end = np.array([end_id], "<u4").tobytes()
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // range_bytes), spark.sparkContext.defaultParallelism if total > (4 << 20) else 1)
    ordered = narrow.repartitionByRange(parts, "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode, part = load(tokenizer_path, special_tokens).many, TaskContext.get().partitionId()
        system, base = open_store(out_uri)
        names = [f"{base}/part-{part:06d}-{uuid.uuid4().hex}.{kind}.arrow" for kind in ("ids", "docs")]
        ids_sink = writer = None
        docs_seen: list[int | None] = []
        lengths: list[int] = []
        for batch in batches:
            if writer is None:
                system.create_dir(base, recursive=True)
                ids_sink = system.open_output_stream(names[0])
                writer = SequenceWriter(ids_sink, sequence_length, dtype)
            for doc, raw in zip(batch.column(0).to_pylist(), encode(v.as_py() for v in batch.column(1)), strict=True):
                ids = np.frombuffer(raw + end, "<u4")
                writer.add(ids)
                docs_seen.append(doc)
                lengths.append(len(ids))
        if writer is None:
            return
        writer.close()
        ids_sink.close()
        table = pa.table({"doc_id": pa.array(docs_seen, pa.int64()), "n_tokens": pa.array(lengths, pa.int64())})
        with system.open_output_stream(names[1]) as sink, ipc.new_file(sink, table.schema) as index:
            index.write_table(table, 65_536)
        yield pa.RecordBatch.from_pylist([{"part": part, "ids_file": names[0], "docs_file": names[1], "n_documents": len(lengths), "n_tokens": sum(lengths)}], schema=pa.schema([("part", pa.int32()), ("ids_file", pa.string()), ("docs_file", pa.string()), ("n_documents", pa.int64()), ("n_tokens", pa.int64())]))

    return store.written(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: ids in all files before.  It has one row per file of RANGE_BYTES of text."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, manifest: DataFrame, out_uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone; one file is read per task step."""
    files = with_starts(manifest)
    rows = manifest.count()
    spread = files.repartition(max(1, min(rows, 10_000)), "part")

    def run(batches) -> Iterator[pa.RecordBatch]:
        system, _ = open_store(out_uri)
        for batch in batches:
            for f in batch.to_pylist():
                with system.open_input_file(f["docs_file"]) as source:
                    index = ipc.open_file(source).read_all()
                lengths = index["n_tokens"].to_numpy()
                crcs = np.empty(len(lengths), np.int64)
                with system.open_input_file(f["ids_file"]) as source:
                    crcs[:] = list(_crcs(ipc.open_file(source), lengths))
                starts = f["start"] + np.cumsum(lengths) - lengths
                whole = pa.RecordBatch.from_arrays([index["doc_id"].combine_chunks(), pa.array(starts), pa.array(lengths), pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield from (whole.slice(k, 20_000) for k in range(0, len(lengths), 20_000))

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _crcs(file: ipc.RecordBatchFileReader, lengths: np.ndarray) -> Iterator[int]:
    """crc32 of each document's ids as little-endian unsigned 32-bit integers, a batch of sequences in memory at a time."""
    held, batch = np.zeros(0, "<u4"), 0

    def more() -> np.ndarray:
        nonlocal batch
        got = file.get_batch(batch)
        batch += 1
        ids, mask = (got.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
        return ids[mask].astype("<u4")

    for n in lengths.tolist():
        crc = 0
        while n > len(held):
            crc, n = zlib.crc32(held.tobytes(), crc), n - len(held)
            held = more()
        crc, held = zlib.crc32(held[:n].tobytes(), crc), held[n:]
        yield crc
