"""Training-set construction: label gates, quality tiers, splits, samples, crops from annotated cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import text as T
from ..sources.scratch import scratch

#: rows that a task numbers as one
SLOT_ROWS = 20_000

# The characters that crop labels may use.
CHARSET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÇÉÈÊËÎÏÔÙÛÜŸŒÆàâçéèêëîïôùûüÿœæ0123456789 .,;:!?\"'()-"


def ctc_limit(width: int, stride: int) -> int:
    """Longest label that a width of so many strides can spell, two kept in reserve."""
    return max(1, width // max(1, stride)) - 2


def gate(rows: DataFrame, limit: int, max_len: int | None = None, charset: str | None = None, images: DataFrame | None = None) -> DataFrame:
    """rows (path, label) with ``status`` and the normalised ``label``.

    The checks in order: malformed, empty, (cut to ``max_len``), too_long, out_of_charset,
    missing.  Length is measured before normalisation, which may lengthen a label or leave
    it empty; such a label still passes.
    """
    cut = F.col("label") if max_len is None else F.substring("label", 1, max_len)
    marked = rows.withColumn("__cut", cut).withColumn("__norm", T.norm_label("__cut"))
    status = F.when(F.col("path").isNull() | F.col("label").isNull(), "malformed").when(F.col("label") == "", "empty").when(F.length("__cut") > limit, "too_long")
    if charset is not None:
        status = status.when(F.length(F.translate("__norm", charset, "")) > 0, "out_of_charset")
    if images is not None:
        marked = marked.join(images.select(F.col("path").alias("__p"), F.lit(True).alias("__there")).distinct(), F.col("path") == F.col("__p"), "left")
        status = status.when(F.col("__there").isNull(), "missing")
    return marked.select("path", F.col("__norm").alias("label"), status.otherwise("kept").alias("status"))


def tier() -> Column:
    """A, B or C of a crop's quality metrics; missing metrics are C."""
    c = F.col
    good = (c("h") >= 22) & (c("ratio") <= 10) & (c("edge_ink") <= 0.02) & (c("lap_var") >= 60) & (c("std") >= 25) & c("black").between(0.15, 0.85) & (c("oov") == 0) & c("len").between(3, 80) & (c("too_small_h") == 0) & (c("crazy_ratio") == 0)
    bad = (c("too_small_h") != 0) | (c("crazy_ratio") != 0) | (c("edge_ink") > 0.08) | (c("oov") > 0) | (c("h") < 16) | (c("ratio") > 20) | (c("lap_var") < 20) | (c("std") < 10) | (c("black") < 0.05) | (c("black") > 0.95)
    return F.when(c("h").isNull(), "C").when(good, "A").when(bad, "C").otherwise("B")


def hash_order(key: str, seed: int) -> Column:
    """A reproducible random order: the SHA-256 of key and seed."""
    return F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))), 256)


def ranked(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """rows with ``place`` from 1 in hash order.

    The first hexadecimal digits deal rows to slots of equal share, as many digits as hold a
    slot near SLOT_ROWS rows; only a slot is sorted as one, and the slots' counts are summed
    before.
    """
    digits = 1
    slots = rows.count() / SLOT_ROWS
    while 16**digits < slots:
        digits += 1
    slotted = rows.withColumn("__h", hash_order(key, seed)).withColumn("__slot", F.substring("__h", 1, digits))
    counts = slotted.groupBy("__slot").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy("__slot").orderBy("__h", key))
    local = slotted.withColumn("__own", own).join(before, "__slot")
    return local.withColumn("place", F.col("__before") + F.col("__own")).drop("__h", "__slot", "__own", "__before")


def split(rows: DataFrame, key: str, val: float, test: float, seed: int = 42) -> DataFrame:
    """rows with ``split``: val and test get max(1, round half to even of their share), train the rest."""
    n = rows.count()
    n_val, n_test = max(1, round(n * val)), max(1, round(n * test))
    part = F.when(F.col("place") <= n_val, "val").when(F.col("place") <= n_val + n_test, "test").otherwise("train")
    return ranked(rows, key, seed).withColumn("split", part).drop("place")


def _ranges(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with ``__part``, the number of their range in order of the keys, some SLOT_ROWS rows a range.

    They are written to the shared folder and read again, so that a task that runs twice sees
    the same ranges.  Rows of equal keys are in one range.
    """
    spark = rows.sparkSession
    parts = max(1, -(-rows.count() // SLOT_ROWS))
    path = scratch(spark, "ranges")
    rows.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(StructType([*rows.schema.fields, StructField("__part", IntegerType())])).parquet(path)


def running(rows: DataFrame, order: str | list[str], n: Column, group: str | None = None) -> DataFrame:
    """rows with ``before``, the sum of ``n`` (nulls none) over the rows earlier in order, of the same group if one is named.

    Ranges of rows are summed first and the ranges' sums are added up, so that no task sees
    more of a group than its share of a range.  The order should be of unique values.
    """
    by, order = [] if group is None else [group], [order] if isinstance(order, str) else order
    ranges = _ranges(rows, *by, *order).withColumn("__n", F.coalesce(n, F.lit(0)))
    earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = ranges.groupBy(*by, "__part").agg(F.sum("__n").alias("__t"))
    sums = sums.withColumn("__before", earlier(Window.partitionBy(*by).orderBy("__part"), "__t")).drop("__t")
    local = ranges.withColumn("__local", earlier(Window.partitionBy(*by, "__part").orderBy(*order), "__n")).alias("r")
    joined = local.join(sums.alias("s"), [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*by, "__part"]])
    return joined.select(*(F.col(f"r.`{c}`") for c in rows.columns), (F.col("s.__before") + F.col("r.__local")).alias("before"))


def until_target(docs: DataFrame, key: str, n: str, target: int) -> DataFrame:
    """docs up to and with the one at which the running sum of ``n`` in key order reaches the target."""
    return running(docs, key, F.col(n)).where(F.col("before") < target).drop("before")


def nearest(rows: DataFrame, distance: str, key: str, most: int) -> DataFrame:
    """The ``most`` rows of least distance, those without one last, ties in order of the key.

    The distance at which the number is reached is found from the counts of all distances;
    only rows at that distance are numbered.
    """
    if most <= 0:
        return rows.limit(0)
    last = F.col(distance).isNull()
    counted = rows.groupBy(last.alias("__last"), distance).agg(F.count(F.lit(1)).alias("__rows"))
    upto = F.col("before") + F.col("__rows")
    edge = running(counted, ["__last", distance], F.col("__rows")).where((F.col("before") < most) & (upto >= most)).first()
    if edge is None:
        return rows
    ties = running(rows.where(F.col(distance).eqNullSafe(F.lit(edge[distance]))), key, F.lit(1)).where(F.col("before") < most - edge["before"]).drop("before")
    nearer = ~last if edge["__last"] else F.col(distance) < F.lit(edge[distance])
    return rows.where(nearer).unionByName(ties)


def to_xyxy(box: Column) -> dict[str, Column]:
    """Corners of a 4-vector; one whose third and fourth numbers are positive counts as x, y, width, height."""
    x, y, a, b = (F.get(box, k).cast("double") for k in range(4))
    sized = (a > 0) & (b > 0)
    return {"x0": x, "y0": y, "x1": F.when(sized, x + a).otherwise(a), "y1": F.when(sized, y + b).otherwise(b)}


def clipped(corners: dict[str, Column], width: Column, height: Column) -> dict[str, Column]:
    """Corners rounded half to even and held within the page."""
    hold = lambda c, most: F.greatest(F.lit(0), F.least(F.rint(c).cast("int"), most))
    return {k: hold(c, width if k[0] == "x" else height) for k, c in corners.items()}


def reading_order(cells: Column) -> Column:
    """Cells sorted by the top, then the left, then the place of their boxes."""
    keyed = F.transform(cells, lambda c, i: F.struct(F.get(c["bbox"], 1).alias("y"), F.get(c["bbox"], 0).alias("x"), i.alias("i"), c["text"].alias("text"), c["bbox"].alias("bbox")))
    return F.array_sort(keyed)


def crops(pages: DataFrame, width: int, height: int, limit: int) -> DataFrame:
    """(stem, k, path, label, box) of the cells that make a training pair.

    ``k`` is the place in reading order, skipped cells counted.  A cell is skipped if its text
    is empty or longer than the limit, or its clipped box is empty.
    """
    each = pages.select("stem", F.posexplode(reading_order(F.col("cells"))).alias("k", "cell"))
    box = clipped(to_xyxy(F.col("cell.bbox")), F.lit(width), F.lit(height))
    label = T.strip_control(F.coalesce(F.col("cell.text"), F.lit("")))
    rows = each.select("stem", "k", label.alias("label"), *(c.alias(n) for n, c in box.items()))
    usable = rows.where((F.col("label") != "") & (F.length("label") <= limit) & (F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")))
    return usable.withColumn("path", F.concat(F.lit("crops/"), "stem", F.lit("_"), F.lpad(F.col("k").cast("string"), 4, "0"), F.lit(".png")))


def stem_normalised(c: Column) -> Column:
    """A stem without a trailing _dddd, if something stands before it."""
    return F.regexp_replace(c, r"^(.+)_\d{4}\z", "$1")


def priority_lookup(images: DataFrame, index: DataFrame) -> DataFrame:
    """images (stem) with ``json``: the first hit of stem, then normalised stem, among json stems, original names and page hashes.

    index: (json, json_stem, original_stem, page_hash).  Of several entries of a key the
    greatest json path counts.  Six rows per image meet the index in one equi-join.
    """
    kinds = ["json_stem", "original_stem", "page_hash"]
    keys = index.select("json", F.explode(F.array(*(F.struct(F.lit(i).alias("kind"), F.col(k).alias("key")) for i, k in enumerate(kinds)))).alias("e")).select("json", "e.*").where("key IS NOT NULL")
    keys = keys.groupBy("kind", "key").agg(F.max("json").alias("json"))
    tries = [F.struct(F.lit(3 * s + i).alias("prio"), F.lit(i).alias("kind"), c.alias("key")) for s, c in enumerate((F.col("stem"), stem_normalised(F.col("stem")))) for i in range(3)]
    asked = images.select("stem", F.explode(F.array(*tries)).alias("t")).select("stem", "t.*")
    found = asked.join(keys, ["kind", "key"], "left")
    hit = F.when(F.col("json").isNotNull(), F.col("prio"))
    return found.groupBy("stem").agg(F.min_by("json", hit).alias("json"))


def chunked(rows: DataFrame, group: str, order: str, text: str, seed: int = 0) -> DataFrame:
    """Consecutive rows of each group joined two to five at a time; joined texts of 10 to 100 characters stay.

    A block of 14 rows is cut into runs of 2, 3, 4 and 5 in one of four rotations, chosen by a
    hash of group, block and seed, so sizes vary and a rerun agrees.
    """
    numbered = running(rows, order, F.lit(1), group).withColumnRenamed("before", "__p").withColumn("__block", F.floor(F.col("__p") / 14))
    turn = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", F.col(group).cast("string"), F.col("__block").cast("string"), F.lit(str(seed)))), 1, 6), 16, 10).cast("int"), F.lit(4))
    at = F.pmod(F.col("__p"), F.lit(14))
    sizes = [2, 3, 4, 5]
    run = F.lit(0)
    for t in range(4):
        order_of = sizes[t:] + sizes[:t]
        edges = [sum(order_of[: k + 1]) for k in range(3)]
        run = F.when(turn == t, sum(((at >= e).cast("int") for e in edges), F.lit(0))).otherwise(run)
    keyed = numbered.withColumn("__run", run)
    joined = keyed.groupBy(group, "__block", "__run").agg(F.sort_array(F.collect_list(F.struct("__p", F.col(text).alias("t")))).alias("l"))
    out = joined.select(group, F.array_join(F.transform("l", lambda s: s["t"]), " ").alias(text))
    return out.where(F.length(text).between(10, 100))
