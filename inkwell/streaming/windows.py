"""Structured Streaming: event-time windows, and documents scored as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table's Parquet files as a stream."""
    batch = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir) if sf_dir and _is_file(spark, f"{sf_dir}/{table}.parquet") else spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/{table}.parquet")


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what there is now into a Parquet table, with its checkpoint beside it, and read that."""
    spark = stream.sparkSession
    path = scratch(spark, name)
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{path}-log").option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def tumbling_totals(spark: SparkSession, sf_dir: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(event_type, hour, n, total) by event-time window.

    In append mode a window is written once the watermark has passed it; windows still open
    when the input ends are those that begin after the last watermark, so the rest of the
    events is added by a batch pass over them.
    """
    at = F.col("ts").cast("timestamp")  # a stamp without zone is read in the session's
    events = source(spark, sf_dir, "events").withColumn("ts", at)
    by = [F.window("ts", length).alias("w"), "event_type"]
    agg = [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]
    closed = drained(events.withWatermark("ts", late).groupBy(*by).agg(*agg), "windows")
    batch = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", at).groupBy(*by).agg(*agg)
    open_ = batch.join(closed.select("w", "event_type"), ["w", "event_type"], "left_anti")
    return closed.unionByName(open_).select("event_type", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n", F.round("total", 4).alias("total"))


def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n) of documents as they arrive, each once, appended to a table."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    return drained(docs.dropDuplicates(["doc_id"]).select("doc_id", F.length("text").alias("n")), "scored")
