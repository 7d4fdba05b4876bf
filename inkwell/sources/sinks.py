"""Writers and incremental writes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def write_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """A folder per document with its text; line breaks stay, as the line separator is none that a text holds."""
    docs.select(F.col(key), F.col(text).alias("value")).write.option("lineSep", "\x1e").partitionBy(key).text(path)


def append_rows(rows: DataFrame, path: str) -> None:
    """Append to a Parquet table: the header is the schema, so it is written once by nature."""
    rows.write.mode("append").parquet(path)


def _files(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def append_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    """Append to a folder of CSV files whose one header is the file ``_header.csv``.

    That name sorts before those of the parts and is passed over by Spark's readers: the
    folder's files one after the other are a CSV file with its header once.  The header is
    written with the first rows and must be the same ever after.
    """
    line = sep.join(rows.columns) + "\n"
    fs, header = _files(rows.sparkSession, f"{path}/_header.csv")
    if fs.exists(header):
        if _header(rows.sparkSession, path) != line:
            raise ValueError(f"{path} has other columns than {rows.columns}")
    else:
        out = fs.create(header, False)
        out.write(line.encode())
        out.close()
    rows.write.mode("append").options(sep=sep, header=False, escape='"').csv(path)


def _header(spark: SparkSession, path: str) -> str:
    fs, header = _files(spark, f"{path}/_header.csv")
    file = fs.open(header)
    try:
        return bytes(file.readAllBytes()).decode()
    finally:
        file.close()


def appended_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """The rows of an append_csv() folder; its header must name the schema's columns in order."""
    rows = spark.read.options(sep=sep, header=False, escape='"', multiLine=True).schema(schema).csv(path)
    if _header(spark, path) != sep.join(rows.columns) + "\n":
        raise ValueError(f"{path} has other columns than {rows.columns}")
    return rows


def overwrite_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    rows.write.mode("overwrite").options(sep=sep, header=True, escape='"').csv(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """An object per line, characters unescaped."""
    rows.write.json(path)


def write_json_arrays(rows: DataFrame, path: str) -> None:
    """Files that are a JSON array each, an object per line, characters unescaped; a partition without rows is an empty array."""

    def bracketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for frame in batches:
            if len(frame):
                lines = "," + frame["value"]
                lines.iloc[0] = lead + frame["value"].iloc[0]
                lead = ","
                yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).mapInPandas(bracketed, "value string").write.text(path)


def pair_line(path: Column, label: Column) -> Column:
    """``path TAB label`` with control white space of both made spaces; null if either is empty."""
    p, l = X.strip_control(path), X.strip_control(label)
    return F.when((p != "") & (l != ""), F.concat_ws("\t", p, l))


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The items without an output yet."""
    return items.join(done.select(key), key, "left_anti")


def attempted(items: DataFrame, work: Callable[[str], str], column: str, attempts: int = 2) -> DataFrame:
    """items with ``result`` and ``status`` OK or ECHEC: work on each value, tried up to ``attempts`` times."""

    @F.pandas_udf("result string, status string")
    def run(values: pd.Series) -> pd.DataFrame:
        def one(v: str) -> tuple[str | None, str]:
            for _ in range(attempts):
                try:
                    return work(v), "OK"
                except Exception:  # foreign work: what fails twice is logged, not raised
                    continue
            return None, "ECHEC"

        return pd.DataFrame([one(v) for v in values], columns=["result", "status"])

    return items.withColumn("__r", run(F.col(column))).select(*items.columns, "__r.*")


def fingerprint(files: DataFrame, name: str, content: str, version: str = "v1") -> DataFrame:
    """One row: SHA-256 over the sorted (name, SHA-256 of content) of all files, salted by a version.

    Hashes are gathered in one row: 64 bytes a file, for listings of files, not of rows.
    """
    each = files.select(F.col(name).alias("n"), F.sha2(content, 256).alias("h"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "h"))), lambda s: F.concat_ws(":", s["n"], s["h"])), "\n")
    return each.agg(F.sha2(F.concat(F.lit(version + "\n"), joined), 256).alias("fingerprint"))


def inputs_digest(files: DataFrame) -> DataFrame:
    """One row: SHA-1 over the sorted name, time and size of all files."""
    line = F.concat_ws(":", "name", "stamp", F.col("length").cast("string"))
    return files.select(line.alias("l")).agg(F.sha1(F.array_join(F.sort_array(F.collect_list("l")), "\n")).alias("digest"))


def unchanged(count: int, manifest: DataFrame, outputs: Sequence[str]) -> bool:
    """Whether a rebuild can be skipped: the manifest's last count is this one and every output path is there."""
    last = manifest.orderBy(F.desc("built")).first()
    if last is None or last["n_inputs"] != count:
        return False
    return all(fs.exists(path) for fs, path in (_files(manifest.sparkSession, o) for o in outputs))
