"""Appends that happen once, though tasks and drivers fail midway."""

import glob

import pytest
from pyspark.sql import functions as F

from inkwell.sources import appends as A

SCHEMA = "id long, name string"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA).repartition(3)


def read(spark, path):
    return sorted(map(tuple, A.appended(spark, path, SCHEMA).collect()), key=str)


def test_runs_append_once_under_one_header(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    first = [(1, 'a "quoted", text'), (2, "two\nlines"), (3, None), (None, "é")]
    A.append_once(rows(spark, first), path, "run-1")
    A.append_once(rows(spark, first), path, "run-1")  # the same job again
    A.append_once(rows(spark, [(5, "x")]), path, "run-2")
    A.append_once(rows(spark, []), path, "run-3")
    assert read(spark, path) == sorted([*first, (5, "x")], key=str)
    with pytest.raises(Exception, match="other columns"):
        A.append_once(rows(spark, [(6, "y")]).withColumnRenamed("name", "other"), path, "run-4")
    assert read(spark, path) == sorted([*first, (5, "x")], key=str)
    assert open(f"{tmp_path}/log/_header.csv").read() == "id,name\n"
    with pytest.raises(ValueError):
        A.append_once(rows(spark, first), path, "../x")


def test_a_failed_task_leaves_nothing_and_a_second_try_appends_once(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    A.append_once(rows(spark, [(1, "a")]), path, "first")
    bad = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.lit("b")).cast("string").alias("name"))
    with pytest.raises(Exception, match="lost"):
        A.append_once(bad, path, "second")
    assert read(spark, path) == [(1, "a")]
    A.append_once(spark.range(100).select("id", F.lit("b").alias("name")), path, "second")
    assert len(read(spark, path)) == 101


def test_a_driver_lost_before_its_manifest_appends_once_when_it_returns(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/log"
    A.append_once(rows(spark, [(1, "a")]), path, "first")
    # what a lost driver leaves: parts that no manifest names
    writer = A.OnceWriter(path, "second", ",", ["id", "name"])
    part = writer.write(iter([(2, "b"), (3, "c")]))
    assert part.rows == 2 and len(glob.glob(f"{tmp_path}/log/part-second-*")) == 1
    assert read(spark, path) == [(1, "a")]
    A.append_once(rows(spark, [(2, "b"), (3, "c")]), path, "second")
    assert read(spark, path) == [(1, "a"), (2, "b"), (3, "c")]
    # a second driver of the same run comes too late: its parts go
    late = writer.write(iter([(2, "b"), (3, "c")]))
    writer.commit([late, None])
    assert read(spark, path) == [(1, "a"), (2, "b"), (3, "c")] and not glob.glob(f"{tmp_path}/log/{late.name}")
    aborted = writer.write(iter([(9, "z")]))
    writer.abort([aborted, None])
    assert not glob.glob(f"{tmp_path}/log/{aborted.name}")
    assert writer.write(iter([])).rows == 0
