"""Analytics over a score table (doc_id, idx, params, cer, jacc_multi, ratios_mean).

Every argmin and argmax breaks ties by the variant's index, smallest first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CER_OK, JACCARD_OK, RATIO_OK = 0.08, 0.92, (0.9, 1.1)


def clip(c: str = "cer", most: float = 2.0) -> Column:
    """Values above ``most`` set to it; a null stays null."""
    return F.when(F.col(c) > most, F.lit(most)).otherwise(F.col(c))


def success() -> Column:
    low, high = RATIO_OK
    hits = [F.col("cer") < CER_OK, F.col("jacc_multi") > JACCARD_OK, (F.col("ratios_mean") > low) & (F.col("ratios_mean") < high)]
    return F.coalesce(hits[0], F.lit(False)) | F.coalesce(hits[1], F.lit(False)) | F.coalesce(hits[2], F.lit(False))


def best(key: Column, value: str = "idx") -> Column:
    """The value of the row with the least (key, idx), rows of null key aside."""
    return F.min_by(F.col(value), F.when(key.isNotNull(), F.struct(key.alias("k"), F.col("idx"))))


def winners(scores: DataFrame) -> DataFrame:
    """Per document the best variant by error rate, by multiset Jaccard and by ratio closest to one; one shuffle, no join."""
    return scores.groupBy("doc_id").agg(best(F.col("cer")).alias("by_cer"), best(-F.col("jacc_multi")).alias("by_jacc"), best(F.abs(F.col("ratios_mean") - 1)).alias("by_ratio"))


def profile_by_variant(scores: DataFrame) -> DataFrame:
    """Mean, deviation, median, extremes of the error rate, rows at the variant's own extremes, and row count.

    Equal rates of a variant are counted first, so that the median and the extremes are taken
    from one row per distinct rate.
    """
    whole = scores.groupBy("idx").agg(F.avg("cer").alias("mean_cer"), F.stddev_samp("cer").alias("std_cer"))
    rates = scores.groupBy("idx", "cer").agg(F.count("cer").alias("__n"))
    # a variant without any rate keeps a row: its null counts once, and percentiles pass over it
    spread = rates.groupBy(F.col("idx").alias("__idx")).agg(
        F.percentile("cer", 0.5, F.greatest("__n", F.lit(1))).alias("median_cer"),
        F.coalesce(F.min_by("__n", "cer"), F.lit(0)).alias("n_min"), F.coalesce(F.max_by("__n", "cer"), F.lit(0)).alias("n_max"), F.sum("__n").alias("n"),
    )
    return whole.join(spread, F.col("idx").eqNullSafe(F.col("__idx"))).select("idx", "mean_cer", "std_cer", "median_cer", "n_min", "n_max", "n")


def pivot(scores: DataFrame, variants: Sequence[int], value: Column) -> DataFrame:
    """A row per document, a column v<idx> per variant."""
    wide = scores.groupBy("doc_id").pivot("idx", list(variants)).agg(value)
    return wide.select("doc_id", *(F.col(str(v)).alias(f"v{v}") for v in variants))


def greedy_cover(scores: DataFrame) -> DataFrame:
    """(step, idx, gain): variants in the order in which each covers most documents not covered yet.

    Documents are first reduced to the sets of variants that succeed on them, counted: the
    loop works on one row per distinct set and takes at most one round per variant.  Ties
    go to the smallest index; it stops at no gain.
    """
    spark = scores.sparkSession
    sets = scores.where(success()).groupBy("doc_id").agg(F.sort_array(F.collect_set("idx")).alias("by")).groupBy("by").agg(F.count(F.lit(1)).alias("n")).cache()
    chosen: list[tuple[int, int, int]] = []
    while True:
        left = sets
        for _, idx, _ in chosen:
            left = left.where(~F.array_contains("by", idx))
        top = left.select(F.explode("by").alias("idx"), "n").groupBy("idx").agg(F.sum("n").alias("gain")).orderBy(F.desc("gain"), "idx").first()
        if top is None or not top.gain:
            break
        chosen.append((len(chosen) + 1, top.idx, top.gain))
    sets.unpersist()
    return spark.createDataFrame(chosen, "step int, idx int, gain long")
