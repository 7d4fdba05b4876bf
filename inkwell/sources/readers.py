"""Readers of the corpus's file formats; every one takes a schema, none infers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

ANNOTATION = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField(c, T.StringType()) for c in ("original_filename", "page_hash", "doc_category")])),
    T.StructField("meta", T.StructType([T.StructField(c, T.StringType()) for c in ("original_filename", "page_hash", "doc_category")])),
    T.StructField("cells", T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("bbox", T.ArrayType(T.DoubleType()))]))),
])
LABEL_MAP = T.StructType([T.StructField("labels", T.MapType(T.StringType(), T.StringType()))])


def stem(path: Column) -> Column:
    """File name without folders and last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/", -1), -1), r"\.[^.]*\z", "")


def whole_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(stem, text): one row per UTF-8 file, stripped, without a byte-order mark."""
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    return raw.select(stem(F.col("_metadata.file_name")).alias("stem"), X.strip(F.regexp_replace("value", "^﻿", "")).alias("text"))


def lossy_texts(spark: SparkSession, path: str, glob: str = "*", folder: str | None = None) -> DataFrame:
    """whole_texts() of files that may hold invalid UTF-8, which is left out; with ``folder`` the value of the path's part ``<folder>=``, too."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    valid = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit(""))
    part = [] if folder is None else [F.regexp_extract("path", f"/{folder}=([^/]*)/", 1).alias("folder")]
    return raw.select(*part, stem(F.col("path")).alias("stem"), X.strip(valid).alias("text"))


def delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True) -> DataFrame:
    """A delimiter-separated file with a header; NaN in number columns is null."""
    return spark.read.options(sep=sep, header=header, nanValue="NaN", enforceSchema=True, escape='"', multiLine=True).schema(schema).csv(path)


def positional(spark: SparkSession, path: str, sep: str, least: int, most: int | None = None) -> DataFrame:
    """(fields): the lines of a headerless file with at least ``least`` and at most ``most`` fields."""
    n = F.size("fields")
    rows = spark.read.text(path).select(F.split("value", f"\\Q{sep}\\E", -1).alias("fields"))
    return rows.where((n >= least) & (n <= (most if most is not None else 1 << 30)))


def path_and_label(line: Column) -> tuple[Column, Column]:
    """A training line's path and label: cut at the first TAB, else after its first word; both null if it has no two parts."""
    tab = F.split(line, "\t", 2)
    has_tab = F.instr(line, "\t") > 0
    trimmed = X.strip(line)
    first, rest = (F.regexp_extract(trimmed, f"^({X.NOT_WS}+){X.WS}+((?s:.+))\\z", k) for k in (1, 2))
    path = F.when(has_tab, X.strip(F.get(tab, 0))).when(first != "", first)
    label = F.when(has_tab, X.strip(F.get(tab, 1))).when(first != "", X.strip(rest))
    usable = (trimmed != "") & (path != "")
    return F.when(usable, path), F.when(usable, label)


def train_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, label) of a training list."""
    p, l = path_and_label(F.col("value"))
    return spark.read.text(path).select(p.alias("path"), l.alias("label"))


def annotations(raw: DataFrame, json: str = "value") -> DataFrame:
    """raw with ``page``, the parsed annotation; null where the JSON is broken or no object."""
    return raw.withColumn("page", F.when(F.col(json).rlike(r"^\s*\{"), F.from_json(json, ANNOTATION)))


def category(page: str = "page") -> Column:
    return F.coalesce(F.col(f"{page}.metadata.doc_category"), F.col(f"{page}.meta.doc_category"), F.lit("unknown"))


def cells_text(page: str = "page") -> Column:
    """Non-empty cell texts by line."""
    texts = F.transform(F.col(f"{page}.cells"), lambda c: c["text"])
    return F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n")


def label_rows(raw: DataFrame, json: str = "value") -> DataFrame:
    """A row (key, label) per entry of each label map."""
    return raw.select("*", F.explode(F.from_json(json, LABEL_MAP)["labels"]).alias("key", "label"))


def sections_value(value: Column) -> Column:
    """A field that is a string or an array of strings, as an array."""
    return F.coalesce(F.from_json(value, T.ArrayType(T.StringType())), F.array(value))


def lexicon(spark: SparkSession, path: str, with_space: bool = False) -> DataFrame:
    """(token): the trimmed non-blank lines; a character set also has the space."""
    rows = spark.read.text(path).select(X.strip("value").alias("token")).where("token <> ''")
    return rows.union(spark.createDataFrame([(" ",)], "token string")) if with_space else rows


def correction_map(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(pattern, replacement) of a correction file, in file order: a hand-kept list of some hundred lines, read on the driver.

    A file that is not there is an empty list.
    """
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return []
    rows = spark.read.text(path, wholetext=True).collect()
    lines = "\n".join(r.value for r in rows).splitlines()
    return [tuple(line.strip().split(",", 1)) for line in lines if "," in line]


def listing(spark: SparkSession, path: str, extensions: tuple[str, ...], recursive: bool = True) -> DataFrame:
    """(name, length, modificationTime) of the files of some extensions, without their content."""
    glob = "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return files.select(F.element_at(F.split("path", "/", -1), -1).alias("name"), "length", "modificationTime")
