"""WARC archives: writing, and reading by boundary-chain verification.

Archives are written by Spark's text sink, whose line separator ends each record, so they
reach any file system that Spark does and survive lost executors like other output.

They are read in splits, cut at every occurrence of the magic line.  A cut is only a
candidate: the magic may stand inside a payload.  Each task computes for its candidates
the offset where the record would end, which is where its successor must begin.  Within a
split the chain is followed at once; over splits, pointers are doubled from each file's
start; only candidates that the chain reaches are records, and what lies between two of
them is the first one's, whatever it looks like.

Defined results: a null payload is empty; a null URL or id leaves its header out; line
breaks in a URL are dropped; repeated rows make a record each; a table without rows makes
an archive without records; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import store

# Fixed values of the WARC format, version 1.1.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
LEAST_SHARED = 100


def revisits(pages: DataFrame, id_col: str, payload: str, least: int = LEAST_SHARED) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload an earlier page, by id, has already.

    Rows of equal id with different payloads are pages of their own; those with equal ones
    are responses alike.
    """
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha2(F.coalesce(payload, F.lit("")), 256).alias("digest"), F.octet_length(payload).alias("n")).where(f"n >= {least}")
    shared = slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").select("digest", "refers_to")
    return slim.join(shared, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()


def _headers(*lines: tuple[str, Column]) -> Column:
    """Header lines, those with a null value left out."""
    return F.concat(*(F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in lines))


def record(page_id: Column, url: Column, payload: Column, refers_to: Column) -> Column:
    """The text of a record, without the last of the two line breaks that end it."""
    again = refers_to.isNotNull()
    body = F.coalesce(payload, F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END))
    block = F.when(again, F.lit("")).otherwise(F.concat(http, body))
    head = _headers(
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", F.concat(F.lit(f"<{RECORD_ID}"), page_id.cast("string"), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.regexp_replace(url, r"[\r\n]", "")),
        ("WARC-Refers-To", F.concat(F.lit(f"<{RECORD_ID}"), refers_to.cast("string"), F.lit(">"))),
        ("WARC-Profile", F.when(again, F.lit(REVISIT_PROFILE))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2(body, 256))),
        ("Content-Type", F.when(again, F.lit(None).cast("string")).otherwise(F.lit("application/http; msgtype=response"))),
        ("Content-Length", F.octet_length(block)),
    )
    return F.concat(F.lit(MAGIC), head, F.lit("\r\n"), block, F.lit("\r\n"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_SHARED) -> None:
    """One record per row under ``path``, in as many archives as pages has partitions; payloads are not shuffled while the revisits' table is small enough to broadcast."""
    seen = store.written(revisits(pages, id_col, payload, least), "revisits")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("payload"), F.sha2(F.coalesce(payload, F.lit("")), 256).alias("digest"))
    joined = rows.join(seen, ["page_id", "digest"], "left")
    joined.select(record(F.col("page_id"), F.col("url"), F.col("payload"), F.col("refers_to")).alias("value")).write.option("lineSep", "\r\n").text(path)


def _segments(spark: SparkSession, path: str, with_value: bool) -> DataFrame:
    """What lies between two magics, one row each, as a candidate record.

    ``place`` orders the rows of a (file, split).  ``bytes`` are the segment's own;
    ``head`` is its header if that ends within it; ``value`` is the segment itself, kept
    where it does not end exactly as its own header says, or everywhere ``with_value``.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"), "value")
    ended = F.instr("value", END) > 0
    parts = raw.withColumn("bytes", F.octet_length("value").cast("long")).withColumn("head", F.when(ended, F.substring_index("value", END, 1)))
    length = F.regexp_extract("head", r"(?i)(?:^|\r\n)Content-Length: *(\d{1,18})(?:\r\n|$)", 1)
    sized = parts.withColumn("block_at", F.octet_length("head").cast("long") + len(END)).withColumn("block_bytes", F.when(length != "", length.cast("long")))
    span = F.col("block_at") + F.col("block_bytes") + len(END)
    whole = F.coalesce(span == F.col("bytes"), F.lit(False))
    block = F.expr("substring(cast(value AS BINARY), cast(block_at + 1 AS int), cast(block_bytes AS int))")
    return sized.withColumn("span", span).withColumn("whole", whole).withColumn("payload", F.when(whole, _payload(block, F.col("head")))).select(
        "file", "split", "place", "bytes", "head", "span", "whole", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("long").alias("payload_bytes"), (F.col("value") if with_value else F.when(~F.col("whole"), F.col("value"))).alias("value")
    )


def _payload(block: Column, head: Column) -> Column:
    """A block without its HTTP header, if it is an HTTP response."""
    text = block.cast("string")
    at = F.octet_length(F.substring_index(text, END, 1)) + len(END)
    inner = F.call_function("substring", block, at + 1, F.octet_length(block))
    return F.when(head.rlike(r"(?i)Content-Type: *application/http") & (F.instr(text, END) > 0), inner).otherwise(block)


def _placed(segments: DataFrame) -> DataFrame:
    """segments with ``at``, the offset of the magic before each in its file (-10 for what stands before the first), and ``next``."""
    step = len(MAGIC)
    own = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("file", "split").agg((F.sum("bytes") + F.count(F.lit(1)) * step).alias("total"))
    before = totals.select("file", "split", F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    local = segments.withColumn("local", F.coalesce(F.sum(F.col("bytes") + step).over(own), F.lit(0)))
    at = F.col("base") + F.col("local") - step
    return local.join(before, ["file", "split"]).withColumn("at", at).withColumn("next", at + step + F.col("span")).drop("base", "local")


def _exits(chain: DataFrame) -> DataFrame:
    """(file, split, at, exit): where the chain from each candidate leaves its split; null where it breaks."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["at"].to_numpy())
        at, onward = table["at"].to_numpy()[order], table["next"].fill_null(-1).to_numpy()[order]
        out, last = onward.copy(), at[-1]
        where = np.searchsorted(at, onward)
        for i in range(len(at) - 1, -1, -1):
            if 0 <= onward[i] <= last:
                out[i] = out[where[i]] if at[where[i]] == onward[i] and where[i] > i else -1
        return pa.table({"file": table["file"].combine_chunks().take(pa.array(order)), "split": table["split"].combine_chunks().take(pa.array(order)), "at": pa.array(at), "exit": pa.array(out, mask=out < 0)})

    return chain.groupBy("file", "split").applyInArrow(run, "file string, split long, at long, exit long")


def _entries(exits: DataFrame) -> DataFrame:
    """(file, split, at) where the chain from each file's start enters a split, by pointer doubling.

    Only candidates that some split's chains lead to are pointers, and the file's start: a
    few for each split, whatever its candidates.
    """
    jump = exits.select("file", "at", F.col("exit").alias("to")).where("to IS NOT NULL")
    targets = jump.select("file", F.col("to").alias("at")).distinct()
    jump = store.cut(jump.where("at <> 0").join(targets, ["file", "at"], "left_semi").union(jump.where("at = 0")))
    places = exits.select("file", "split", "at")
    reached = store.cut(exits.where("at = 0").select("file", "at"))
    known = reached.count()
    while True:
        step = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = store.cut(reached.union(step).distinct().join(places, ["file", "at"], "left_semi"))
        now = reached.count()
        if now == known:
            return reached.join(places, ["file", "at"])
        known = now
        onward = jump.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        jump = store.cut(jump.join(onward, ["file", "to"]).select("file", "at", F.col("further").alias("to")))


def _reached(chain: DataFrame, entries: DataFrame) -> DataFrame:
    """(file, at) of every record: the chain within each split from where it is entered."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        onward = dict(zip(left["at"].to_pylist(), left["next"].to_pylist(), strict=True))
        found, at = [], min(right["at"].to_pylist(), default=None)
        while at in onward:
            found.append(at)
            at = onward[at] if onward[at] is None or onward[at] > at else None
        return pa.table({"file": pa.array([key[0].as_py()] * len(found), pa.string()), "at": pa.array(found, pa.int64())})

    return chain.groupBy("file", "split").cogroup(entries.groupBy("file", "split")).applyInArrow(run, "file string, at long")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, record_type, page_id, refers_to, url, digest, sha, payload_bytes) of every record.

    ``digest`` is what the header says of the payload, ``sha`` (SHA-256) and
    ``payload_bytes`` what the archive holds of it.
    """
    placed = store.cut(_placed(_segments(spark, path, False)).where("at >= 0"))
    chain = placed.select("file", "split", "at", "next")
    records = store.cut(_reached(chain, _entries(store.cut(_exits(chain)))))
    true = placed.join(records, ["file", "at"])
    simple = true.where("whole").select("file", "at", "head", "sha", "payload_bytes")
    broken = true.where("NOT whole")
    rebuilt = _rebuilt(spark, path, placed, records) if not broken.isEmpty() else simple.limit(0)
    header = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1), F.lit(""))
    page = lambda name: F.nullif(F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}: *<{RECORD_ID}(-?\d+)>", 1), F.lit("")).cast("long")
    return simple.union(rebuilt).select("file", "at", header("WARC-Type").alias("record_type"), page("WARC-Record-ID").alias("page_id"), page("WARC-Refers-To").alias("refers_to"), header("WARC-Target-URI").alias("url"), F.regexp_replace(header("WARC-Payload-Digest"), "^sha256:", "").alias("digest"), "sha", "payload_bytes")


def _rebuilt(spark: SparkSession, path: str, placed: DataFrame, records: DataFrame) -> DataFrame:
    """Records with magics in their payloads, put together again from their segments."""
    marks = placed.select("file", "at", "whole").join(records.withColumn("is_record", F.lit(True)), ["file", "at"], "left")
    owner = F.last(F.when(F.col("is_record"), F.col("at")), ignorenulls=True).over(Window.partitionBy("file").orderBy("at"))
    owned = store.written(marks.withColumn("owner", owner).where("NOT whole OR is_record IS NULL").select("file", "at", "owner"), "warc-parts")
    parts = _placed(_segments(spark, path, True)).select("file", "at", "head", "span", "value").join(owned, ["file", "at"])
    joined = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"), F.min_by("head", "at").alias("head"), F.min_by("span", "at").alias("span"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    at = F.octet_length("head") + len(END)
    block = F.call_function("substring", text.cast("binary"), at + 1, (F.col("span") - at - len(END)).cast("int"))
    payload = _payload(block, F.col("head"))
    return joined.select("file", F.col("owner").alias("at"), "head", F.sha2(payload, 256).alias("sha"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): a revisit gets its response's payload."""
    base = store.cut(records)
    responses = base.where("record_type = 'response'")
    wanted = base.where("record_type = 'revisit'")
    source = responses.join(wanted.select(F.col("refers_to").alias("page_id")).distinct(), "page_id").select(F.col("page_id").alias("refers_to"), F.col("sha").alias("digest"), F.col("sha").alias("rsha"), F.col("payload_bytes").alias("rbytes")).distinct()
    again = wanted.drop("sha", "payload_bytes").join(source, ["refers_to", "digest"], "left").select("page_id", F.col("rbytes").alias("payload_bytes"), F.col("rsha").alias("payload_digest"), "record_type", "refers_to")
    own = responses.select("page_id", "payload_bytes", F.col("sha").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.union(again)
