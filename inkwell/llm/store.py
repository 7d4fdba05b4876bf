"""Shared storage for intermediate results, and the row-wise Arrow wrapper of the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .textkit import Texts, column_texts


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or set as the context's checkpoint folder; one of this machine's own only where both are unset and all runs on this machine (tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        named = context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="inkwell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with the lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: its size is known to the planner, so it is broadcast exactly when small."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def appended_schema(df: DataFrame, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    new = {name for name, _ in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in new] + [T.StructField(n, t) for n, t in fields])


def append_text_columns(df: DataFrame, text: str, compute: Callable[[Texts], list[np.ndarray]], fields: list[tuple[str, T.DataType]]) -> DataFrame:
    """df with the columns that ``compute`` makes of each whole text; a column of the same name is replaced."""
    schema = appended_schema(df, fields)
    kept = [f.name for f in df.schema.fields if f.name not in {n for n, _ in fields}]

    def run(batches):
        for batch in batches:
            parts = [compute(t) for _, _, t in column_texts(batch.column(batch.schema.get_field_index(text)))]
            made = [pa.array(np.concatenate([p[i] for p in parts])) for i in range(len(fields))] if parts else []
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept] + made, names=schema.names)

    return df.mapInArrow(run, schema)
