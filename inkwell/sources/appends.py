"""Appends that happen once: CSV parts of a run become visible by one manifest, whatever tasks or drivers fail on the way.

A task writes its rows to a part of a name of its own and reports it in its commit
message; a task that is tried again writes another part.  When all tasks have reported,
the driver writes the run's manifest, which names the parts and the columns, by renaming a
finished file.  Readers look at manifests only: parts of lost tasks, of failed jobs and of
second attempts are in none.  A run whose manifest is there already adds nothing, so a job
that is started again under its run's name appends once.  ``_header.csv`` holds the one
header, that of the first run; a run with other columns is refused.

Parts are opened by pyarrow, so the folder is of a kind that it reaches from every machine:
``file:`` (a folder that all share), ``hdfs:``, ``s3:``, ``gs:``.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "csv_once"
#: characters that a task holds before it writes them
HELD = 1 << 20


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


def _place(path: str):
    """(file system, path in it) of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _exists(files, path: str) -> bool:
    from pyarrow import fs

    return files.get_file_info(path).type != fs.FileType.NotFound


def _put(files, path: str, content: bytes) -> None:
    """A file that is there whole or not at all."""
    name = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(name) as out:
        out.write(content)
    files.move(name, path)


class OnceWriter(DataSourceWriter):
    def __init__(self, path: str, run: str, sep: str, columns: list[str]) -> None:
        self.path, self.run, self.sep, self.columns = path.rstrip("/"), run, sep, columns

    def write(self, iterator: Iterator) -> Part:
        files, root = _place(self.path)
        name = f"part-{self.run}-{uuid.uuid4().hex}.csv"
        n = 0
        out, held = None, io.StringIO()
        lines = csv.writer(held, delimiter=self.sep, lineterminator="\n")
        try:
            for row in iterator:
                n += 1
                lines.writerow(["" if v is None else v for v in row])
                if held.tell() >= HELD:
                    out = out or files.open_output_stream(f"{root}/{name}")
                    out.write(held.getvalue().encode())
                    held.seek(0)
                    held.truncate()
            if n:
                out = out or files.open_output_stream(f"{root}/{name}")
                out.write(held.getvalue().encode())
        finally:
            if out:
                out.close()
        return Part(name if n else "", n)

    def commit(self, messages: list[Part | None]) -> None:
        files, root = _place(self.path)
        parts = [m for m in messages if m is not None and m.rows]
        if _exists(files, f"{root}/_runs/{self.run}.json"):
            self._drop(files, root, parts)
            return
        header = _line(self.columns, self.sep)
        if not _exists(files, f"{root}/_header.csv"):
            _put(files, f"{root}/_header.csv", header.encode())
        with files.open_input_stream(f"{root}/_header.csv") as held:
            first = held.read().decode()
        if first != header:
            self._drop(files, root, parts)
            raise ValueError(f"{self.path} has other columns than {self.columns}")
        files.create_dir(f"{root}/_runs", recursive=True)
        _put(files, f"{root}/_runs/{self.run}.json", json.dumps({"parts": sorted(p.name for p in parts), "rows": sum(p.rows for p in parts)}).encode())

    def abort(self, messages: list[Part | None]) -> None:
        files, root = _place(self.path)
        self._drop(files, root, [m for m in messages if m is not None and m.rows])

    def _drop(self, files, root: str, parts: list[Part]) -> None:
        for p in parts:
            if _exists(files, f"{root}/{p.name}"):
                files.delete_file(f"{root}/{p.name}")


def _line(values: list[str], sep: str) -> str:
    held = io.StringIO()
    csv.writer(held, delimiter=sep, lineterminator="\n").writerow(values)
    return held.getvalue()


class CsvOnce(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> OnceWriter:
        if overwrite:
            raise ValueError("rows can only be appended")
        return OnceWriter(self.options["path"], self.options["run"], self.options.get("sep", ","), schema.names)


def append_once(rows: DataFrame, path: str, run: str | None = None, sep: str = ",") -> None:
    """Append rows to a folder under a run's name (letters, digits, ``-`` and ``_``); a run that is there already adds nothing."""
    run = run or uuid.uuid4().hex
    if not run.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"not a name of a run: {run}")
    files, root = _place(path)
    files.create_dir(root, recursive=True)
    if _exists(files, f"{root.rstrip('/')}/_runs/{run}.json"):
        return
    rows.sparkSession.dataSource.register(CsvOnce)
    rows.write.format(NAME).mode("append").options(run=run, sep=sep).save(path)


def appended(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """The rows of all runs of a folder; its header must name the schema's columns in order.  An empty text reads as null."""
    runs = spark.read.schema("parts array<string>").json(f"{path.rstrip('/')}/_runs")
    parts = [f"{path.rstrip('/')}/{p}" for r in runs.collect() for p in r["parts"]]
    empty = spark.createDataFrame([], schema)
    files, root = _place(path)
    with files.open_input_stream(f"{root.rstrip('/')}/_header.csv") as held:
        if held.read().decode() != _line(empty.columns, sep):
            raise ValueError(f"{path} has other columns than {empty.columns}")
    return spark.read.options(sep=sep, header=False, escape='"', multiLine=True).schema(schema).csv(parts) if parts else empty
