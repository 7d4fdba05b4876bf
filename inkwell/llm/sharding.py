"""Sharding by proportional stratified interleaving.

Each source's rows are shuffled by a seeded hash and ranked; the fractional rank
(rank + 1/2) / (rows of the source) lies evenly over [0, 1) for every source, so the rows
of all sources in order of it are interleaved in proportion, and every contiguous cut of
that order holds the mixture.  Counts of any two shards differ by one at most.

Defined results: a null source is a source of its own; null texts have no bytes; repeated
rows take a place each; an empty table gives an empty result; other columns pass through
``assign`` (its own names ``shard`` and ``slot`` are replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranks, store

SEED = 20_240


def assign(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", source: str = "source", ties: tuple[str, ...] = (), seed: int = SEED, slot_rows: int = ranks.SLOT_ROWS) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    ``ties`` are columns that tell apart rows of equal id.  Pass the columns that are
    wanted, not whole texts: the rows given are shuffled twice.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    named = store.cut(docs.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("")).alias("__source")))
    total = named.count()
    sizes = store.written(named.groupBy("__source").agg(F.count(F.lit(1)).alias("__n")), "source-sizes")
    order = [F.col(id_col), *(F.col(t) for t in ties)]
    shuffled = named.join(sizes, "__source").withColumn("__key", ranks.hash_key(id_col, seed))
    ranked = ranks.running(shuffled, "__key", order, ["__source"], {"__rank": F.lit(1)}, f"((__n + {slot_rows - 1}) div {slot_rows})")
    spread = store.cut(ranked.withColumn("__share", (F.col("__rank") + F.lit(0.5)) / F.col("__n")).withColumn("__turn", ranks.hash_key("__source", seed)))
    # sources of few rows share their fractions, so their hash deals the rows of one
    placed = ranks.running(spread, "__share", [F.col("__source"), *order], [], {"__place": F.lit(1)}, max(1, -(-total // slot_rows)), "__turn", slot_rows)
    # the first place of shard s is ceil(s * total / shards)
    first = F.expr(f"(__shard * {total} + {shards - 1}) div {shards}")
    exact = placed.withColumn("__shard", F.expr(f"(__place * {shards}) div {max(total, 1)}"))
    return exact.select(*(F.col(f"`{c}`") for c in kept), F.col("__shard").cast("int").alias("shard"), (F.col("__place") - first).alias("slot"))
