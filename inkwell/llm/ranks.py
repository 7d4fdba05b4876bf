"""Ranks and running sums over a uniformly spread key, without one large sorted group.

Rows are dealt to slots of equal width of the key within their group.  The slots' totals
are summed in order (a table whose size is the number of slots), and only the rows of one
slot are sorted together; a group of any share of all rows is spread over as many slots as
it has rows for.  Where many rows share a key's value, a second key that comes next in
order cuts crowded slots by value and then by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

#: rows that a slot aims at
SLOT_ROWS = 20_000


def hash_key(column: str, seed: int) -> Column:
    """A hash-random double in [0, 1) of a column's text: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(column).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") * F.lit(2.0**-52)


def dealt(rows: DataFrame, key: str, group: list[str], slots: int | str, finer: str | None, slot_rows: int) -> DataFrame:
    """rows with __slot, __value and __part, which in this order follow the order of (key, finer).

    ``finer`` is a double in [0, 1).  Slots of more than twice ``slot_rows`` rows are cut at
    every value of the key, and a value's rows into parts of the finer key; __value is -1
    and __part 0 elsewhere.
    """
    n = F.expr(str(slots))
    out = rows.withColumn("__slot", F.least(F.floor(F.col(key) * n), n - 1).cast("long"))
    if finer is None:
        return out.withColumn("__value", F.lit(-1.0)).withColumn("__part", F.lit(0).cast("long"))
    place = [*group, "__slot"]
    crowded = store.written(out.groupBy(*place).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > 2 * slot_rows).select(*place), "crowded-slots")
    values = out.join(crowded, place).groupBy(*place, key).agg(F.expr(f"(count(1) + {slot_rows - 1}) div {slot_rows}").alias("__parts"))
    cut = out.join(store.written(values, "slot-values"), [*place, key], "left")
    part = F.least(F.floor(F.col(finer) * F.col("__parts")).cast("long"), F.col("__parts") - 1)
    there = F.col("__parts").isNotNull()
    return cut.withColumn("__value", F.when(there, F.col(key)).otherwise(F.lit(-1.0))).withColumn("__part", F.when(there, part).otherwise(F.lit(0).cast("long"))).drop("__parts")


def running(rows: DataFrame, key: str, ties: list[Column], group: list[str], sums: dict[str, Column], slots: int | str, finer: str | None = None, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """rows with, per name of ``sums``, the sum over all rows of the group before this one in order of (key, finer, ties).

    ``key`` is a double in [0, 1).  ``ties`` must tell apart rows that are not equal in
    every column that matters.  Group columns must not be null.  ``slots`` is a number or
    an SQL expression that is constant within a group.  ``finer`` is that of dealt(); rows
    are read several times then, so they should be cut off from their lineage.
    """
    kept = rows.columns
    place = [*group, "__slot", "__value", "__part"]
    slotted = dealt(rows, key, group, slots, finer, slot_rows)
    totals = slotted.groupBy(*place).agg(*(F.sum(c).alias(f"__t_{n}") for n, c in sums.items()))
    in_order = (Window.partitionBy(*group) if group else Window).orderBy("__slot", "__value", "__part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*place, *(F.coalesce(F.sum(f"__t_{n}").over(in_order), F.lit(0)).alias(f"__b_{n}") for n in sums))
    in_slot = Window.partitionBy(*place).orderBy(key, *([finer] if finer else []), *ties).rowsBetween(Window.unboundedPreceding, -1)
    local = slotted.select(*kept, *place[len(group) :], *(F.coalesce(F.sum(c).over(in_slot), F.lit(0)).alias(f"__l_{n}") for n, c in sums.items()))
    joined = local.join(before, place)
    return joined.select(*kept, *((F.col(f"__b_{n}") + F.col(f"__l_{n}")).alias(n) for n in sums))
