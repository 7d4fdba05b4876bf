"""Mixing of sources to target weights.

Every document gets a hash-random key.  Within each source the documents are in order of
it, their sizes are summed before each (ranks.running: slots of the key, the slots'
totals, and a sort within a slot only), and the source is cut at its exact budget.  A
budget above the source's size takes whole epochs first and cuts in the next.

Defined results: a null source is a source of its own and sorts last; a null or blank
text has size 0 and is never taken; repeated rows count each time; a source without words
has target 0; an empty table gives an empty result; other columns pass through
``plan`` (its own names are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks, store

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
SEED = 90_210


def word_count(text: str) -> Column:
    """Number of words of a text, 0 if null: each is squeezed to one letter, and what is left beside white space is counted."""
    squeezed = F.regexp_replace(F.col(text), WORD, "w")
    return F.coalesce(F.length(F.translate(squeezed, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(__source, source_size, target) from (__source, source_size), a table of one row per source.

    Sources take the weights in turn, in order of code point.  All sources together get
    ``share`` of all sizes, none more than ``most`` times its own; what a source cannot
    take goes to the others by weight.  With all sources ordered by most * size / weight,
    those that are full are the first k of the order, for the least k at which the rest
    can take its share.
    """
    place = F.row_number().over(Window.orderBy(F.expr("__source = ''"), "__source")) - 1
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    rows = sizes.withColumn("__w", turn).withColumn("__cap", cap).withColumn("__level", F.col("__cap") / F.col("__w"))
    whole = Window.partitionBy()
    order = Window.orderBy("__level", "__source").rowsBetween(Window.unboundedPreceding, -1)
    full_before, weight_before = (F.coalesce(F.sum(c).over(order), F.lit(0.0)) for c in ("__cap", "__w"))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    # the water level if exactly the sources before this one were full
    level = (budget - full_before) / (F.sum("__w").over(whole) - weight_before)
    rows = rows.withColumn("__try", level).withColumn("__open", F.col("__try") <= F.col("__level"))
    first = F.min_by(F.when(F.col("__open"), F.col("__try")), F.when(F.col("__open"), F.struct("__level", "__source"))).over(whole)
    return rows.select("__source", "source_size", F.least(F.col("__cap"), F.col("__w") * F.coalesce(first, F.lit(float("inf")))).alias("target"))


def plan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = SEED, slot_rows: int = ranks.SLOT_ROWS) -> DataFrame:
    """docs without the text, with size, source_size, target and taken (words that the mix takes of the document).

    Within a source, ``taken`` sums to the target rounded down: a document is taken once
    per whole epoch, and the document at the cut gives the words up to it.  ``take_key``
    is its place in the source's order.
    """
    new = ("size", "source_size", "target", "taken", "take_key")
    kept = [c for c in docs.columns if c not in (text, *new)]
    slim = docs.select(*(F.col(f"`{c}`") for c in kept), word_count(text).alias("size"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("")).alias("__source"))
    slim = store.cut(slim)
    sized = store.written(slim.groupBy("__source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__n")), "mix-sizes")
    budgets = store.written(targets(sized.select("__source", "source_size"), weights, share, most), "mix-targets")
    counted = sized.select("__source", "__n")
    slots = f"((__n + {slot_rows - 1}) div {slot_rows})"
    keyed = slim.join(counted, "__source").withColumn("take_key", ranks.hash_key(id_col, seed))
    summed = ranks.running(keyed, "take_key", [F.col(id_col), F.col("size")], ["__source"], {"__before": F.col("size")}, slots)
    joined = summed.join(budgets, "__source")
    goal = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0))
    left = goal - epochs * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("__before")))
    return joined.select(*(F.col(f"`{c}`") for c in kept), "size", "source_size", "target", (epochs * F.col("size") + partial).cast("long").alias("taken"), "take_key")


def materialise(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs as the mix takes them: one per epoch, whole texts; the document at a source's cut enters whole.

    Rows that share an id share their copies: each is repeated as often as the mean of
    what the mix takes of them asks for, rounded up.
    """
    per_id = planned.groupBy(F.col(id_col).alias("__id")).agg(F.sum("taken").alias("__taken"), F.sum("size").alias("__size"))
    copies = per_id.where("__taken > 0").select("__id", F.expr("cast((__taken + __size - 1) div __size as int)").alias("__copies"))
    repeated = docs.join(copies, F.col(id_col).eqNullSafe(F.col("__id")))
    return repeated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*(docs[c] for c in docs.columns))
