"""One query per operator over the whole of its test table, as the contracts ask for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, conversations, embed_dedup, fim, html_extract, langid, mixing, near_dup, packing, quality_rules, sharding, store, token_files, warc
from .oracles import ORACLES


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules.assess(docs).select("doc_id", *quality_rules.STATS, "base_failed", "kept", F.round("host_worst_rate", 6).alias("host_worst_rate"))


def op2_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op4_probminhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, sf_dir, "documents")).drop("text_key")


def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _read(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign(rows, 16, ties=("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.fresh_path(spark, "archives")
    warc.write(_read(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read(spark, path))


def _trainable(labels: DataFrame) -> DataFrame:
    """Labels of the rows that may teach: crc32 of the id's text is not 1 modulo 3."""
    return labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)


def quality_model(spark: SparkSession, sf_dir: str) -> classifier.Discriminant:
    return classifier.train(_read(spark, sf_dir, "documents").select("doc_id", "text"), _trainable(_read(spark, sf_dir, "labels")))


def op7_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return classifier.score(docs, quality_model(spark, sf_dir)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.linked(_read(spark, sf_dir, "embeddings"))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op10_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = store.fresh_path(spark, "token-files")
    manifest = token_files.write(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)
    return token_files.read_documents(spark, manifest, out)


def op11_tight_arc_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(_read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_bit_parallel_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_read(spark, sf_dir, "documents"))


def op13_family_pair_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    model = langid.train(docs.where(fold != 0))
    held_out = F.coalesce(fold == 0, F.lit(False))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_host_quality_rules, op2_differencing_packing, op3_tag_path_text, op4_probminhash_near_dup, op5_stratified_shards, op6_warc_boundary_chain, op7_quadratic_discriminant, op8_projection_forest, op9_weighted_mix, op10_arrow_token_files, op11_tight_arc_repair, op12_bit_parallel_fim, op13_family_pair_language)}

__all__ = ["ORACLES", "QUERIES"]
