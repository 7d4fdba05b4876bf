"""From raw documents to packed training sequences: classifier, rules, near duplicates, mixture, packing.

Each stage takes an empty table (no rows come out), nulls in any column, texts of any length and further columns of any
name, which the first four hand on as they are.  A null or empty text is scored like any other by the classifier and goes
at the rules at the latest, having under 20 words.  A null host or source is one of its own; it is the last.  Repeated
rows are near duplicates of each other, whatever their ids; ties go to the least doc_id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import classifier, mixing, near_dup, packing, quality_rules, queries, store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant, trained on the labelled ones, takes for good (score of 0.5 or more)."""
    model = queries.quality_model(spark, sf_dir)
    return classifier.score(docs, model).where("predicted = 1").select(*docs.columns)


def host_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a base rule nor come from a host whose shrunk failure rate is too high."""
    return quality_rules.assess(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one of least doc_id."""
    return near_dup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mixture takes them: a row for each time, whole; those beyond their source's budget go."""
    return mixing.materialise(docs, mixing.plan(docs.select("doc_id", "text", "source")))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("host_quality_rules", host_quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]

#: the discriminant, signatures and token ids have no SQL form; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = store.fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
