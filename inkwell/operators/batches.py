"""Arrow batches bounded in bytes: what a Python worker holds is a batch and its results, however many rows its task has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: bytes of a batch of rows that goes to Python; a longer row is a batch of its own
BYTES = 4 << 20
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession | None = None) -> None:
    """Bound the session's batches, which by default hold 10,000 rows of any size; a bound that was set stays."""
    spark = spark or SparkSession.active()
    if spark.conf.get(LIMIT, None) is None:
        spark.conf.set(LIMIT, str(BYTES))


def spread(df: DataFrame) -> DataFrame:
    """The same rows in a partition a core at least: a file of one row group is the work of one task, whatever its size and its splits."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(max(cores, parts)) if min(parts, len(df.inputFiles()) or parts) < cores else df
