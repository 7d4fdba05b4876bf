"""The (document x variant) grid and its declared hypothesis provider.

A variant is an ordered processing recipe; the provider here stands for a text extractor
and damages the folded text in a way that depends on document and variant, so that winners
differ, ties occur and some documents are covered by no variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions import text as T
from ..operators.similarity import array_distance, multiset_overlap

VARIANTS = 4
KINDS = 7


def spread(df: DataFrame) -> DataFrame:
    """df over several tasks a core, where its files make fewer: for work that grows with the square of a text, on small inputs."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def dealt(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """df over several tasks a core by its key, for such work behind a shuffle: a number that is named is not made less for small rows."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def variants(spark: SparkSession, n: int = VARIANTS) -> DataFrame:
    """(idx, params): a dimension table of n rows."""
    return spark.createDataFrame([(i, f"recipe-{i:02d}") for i in range(n)], "idx int, params string")


def grid(docs: DataFrame, n: int = VARIANTS) -> DataFrame:
    """Every document with every variant; the variants' few rows are broadcast."""
    return docs.crossJoin(F.broadcast(variants(docs.sparkSession, n)))


def damage(ref: Column, kind: Column) -> Column:
    """The provider: what an extractor with this kind of fault reads for ``ref``."""
    cut = F.substr(ref, F.lit(1), F.floor(F.length(ref) * 2 / 3).cast("int"))
    put = lambda old, new: F.replace(ref, F.lit(old), F.lit(new))
    faults = [ref, put("l", "1"), put(".", ""), F.lower(ref), cut, put("e", "c"), put(" ", "")]
    out = F.when(kind == 0, faults[0])
    for k, fault in enumerate(faults[1:], 1):
        out = out.when(kind == k, fault)
    return out


def kind_of(doc_id: Column, idx: Column) -> Column:
    return (doc_id * 31 + idx * 17) % KINDS


def scored(docs: DataFrame, n: int = VARIANTS) -> DataFrame:
    """(doc_id, source, idx, cer, jacc_multi, ratios_mean) of every cell, over whole texts.

    All three are functions of a cell's two texts, which lie in one row: a pass over the
    documents, and no shuffle.  What depends on the reference alone is computed once a
    document, and counts once a cell, however often the ratios use them.
    """
    refs = spread(docs.select("doc_id", "source", "text")).select("doc_id", "source", T.fold_ascii("text").alias("ref"))
    norm = lambda c: F.lower(T.strip(T.collapse(c)))
    used = metrics.STRUCTURE[:5]

    def read(df: DataFrame, text: str, side: str) -> DataFrame:
        # folded texts are ASCII, whose words are the same in lower case
        out = df.withColumn(f"{side}w", T.words(text))
        counts = metrics.structure(text, F.size(f"{side}w"))
        return out.withColumns({f"{side}n": norm(text), **{f"{side}_{k}": counts[k] for k in used}})

    # of each side a row has the normalised text (n), the words (w) and the counts
    cells = grid(read(refs, "ref", "r"), n).withColumn("kind", kind_of(F.col("doc_id"), F.col("idx")))
    both = read(cells.withColumn("hyp", damage(F.col("ref"), F.col("kind"))), "hyp", "h")
    sides = [{k: F.col(f"{side}_{k}") for k in used} for side in "hr"]
    rated = both.select("doc_id", "source", "idx", F.length("rn").alias("n"), array_distance(F.col("rn"), F.col("hn")).alias("d"), multiset_overlap(F.col("rw"), F.col("hw")).alias("o"), metrics.ratios_mean(*sides).alias("ratios_mean"))
    cer = F.col("d") / F.greatest(F.col("n"), F.lit(1))
    return rated.select("doc_id", "source", "idx", F.coalesce(cer, F.lit(0.0)).alias("cer"), F.coalesce(F.try_divide("o.both", "o.either"), F.lit(1.0)).alias("jacc_multi"), "ratios_mean")
