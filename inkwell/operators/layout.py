"""Page layout: pixel-row runs, cut lines, boxes, lines of boxes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType


def runs(rows: DataFrame, flag: Column, page: str = "page", y: str = "y", least: int = 1) -> DataFrame:
    """(page, start, end): maximal runs of rows that the flag marks, half open, of ``least`` rows or more.

    Rows and their place among the marked ones differ by a constant within a run.
    """
    marked = rows.where(flag)
    island = F.col(y) - F.row_number().over(Window.partitionBy(page).orderBy(y))
    return marked.withColumn("__i", island).groupBy(page, "__i").agg(F.min(y).alias("start"), (F.max(y) + 1).alias("end")).where(F.col("end") - F.col("start") >= least).drop("__i")


def bands(rows: DataFrame, white: int = 250, least: int = 1) -> DataFrame:
    """Runs of rows (page, y, max_px, h) without a white pixel, but those that touch the page's top or bottom."""
    sizes = rows.groupBy("page").agg(F.max("h").alias("h"))
    return runs(rows, F.col("max_px") < white, least=least).join(sizes, "page").where("start > 0 AND end < h")


def segments(rows: DataFrame, white: int = 250, least: int = 1, last_share: float = 0.3) -> DataFrame:
    """(page, k, start, end): what lies between the bands; a last segment much lower than the others' mean is dropped."""
    own = Window.partitionBy("page").orderBy("start")
    band = bands(rows, white, least)
    sizes = rows.groupBy("page").agg(F.max("h").alias("h"))
    before = band.select("page", F.coalesce(F.lag("end").over(own), F.lit(0)).alias("start"), F.col("start").alias("end"))
    ends = sizes.join(band.groupBy("page").agg(F.max("end").alias("last")), "page", "left").select("page", F.coalesce("last", F.lit(0)).alias("start"), F.col("h").alias("end"))
    parts = before.unionByName(ends).where("end > start")
    every = Window.partitionBy("page")
    numbered = parts.withColumn("k", F.row_number().over(own) - 1).withColumn("n", F.count(F.lit(1)).over(every))
    size = F.col("end") - F.col("start")
    others = F.avg(F.when(F.col("k") < F.col("n") - 1, size)).over(every)
    return numbered.withColumn("mean", others).where(~((F.col("n") > 1) & (F.col("k") == F.col("n") - 1) & (size < F.col("mean") * last_share))).select("page", "k", "start", "end")


#: cuts that a task works on at a time
CUTS = 2_000_000


def _cut(h: np.ndarray, is_blank: Callable[[np.ndarray], np.ndarray], slice_height: int, offsets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(cuts of all pages one after the other, number of cuts of each); a step finds the next cut of every page."""
    y = np.zeros(len(h), np.int64)
    going = np.full(len(h), True)
    steps, used = [y], [going]
    while True:
        far = y + slice_height
        going = going & (far < h)
        if not going.any():
            break
        best, open_ = far.copy(), going.copy()
        for d in offsets:
            hit = open_ & (far + d < h) & (far + d > y)
            hit &= is_blank(far + d)
            best[hit] += d
            open_ &= ~hit
        y = np.where(going, best, y)
        steps.append(y)
        used.append(going)
    steps.append(h)
    used.append(np.full(len(h), True))
    marked = np.array(used).T
    return np.array(steps).T[marked], marked.sum(1)


def cut_lines(pages: DataFrame, slice_height: int = 880, step: int = 100, stride: int = 80, is_blank: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """pages (page, h, blank: array of blank rows) with ``cuts``: where a page is cut into slices.

    From each cut the next is so far below, or at the first blank row of a few offsets
    around it.  ``is_blank(page, y)`` stands for the column ``blank`` where a row can be
    told by itself: then a page costs its cuts, not its rows.
    """
    offsets = list(range(-step, step + 1, stride))

    def tester(batch: pa.RecordBatch) -> Callable[[np.ndarray], np.ndarray]:
        if is_blank is not None:
            page = batch["page"].to_numpy(zero_copy_only=False)
            return lambda y: is_blank(page, y)
        rows = batch["blank"]
        span = 1 << 32
        own = np.repeat(np.arange(len(rows)), pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))
        marks = np.unique(own * span + rows.flatten().to_numpy(zero_copy_only=False))
        return lambda y: np.isin(np.arange(len(rows)) * span + y, marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(batch["h"], 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                # pages are taken together while the highest of them, that often, stays below CUTS
                highest = np.maximum.accumulate(sizes[at:]) // (slice_height - step) + 2
                n = max(1, int(np.searchsorted(highest * np.arange(1, len(highest) + 1), CUTS)))
                part = batch.slice(at, n)
                cuts, counts = _cut(sizes[at : at + n], tester(part), slice_height, offsets)
                ends = np.concatenate(([0], np.cumsum(counts)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cuts, pa.int32()), mask=pc.is_null(part["h"]))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "cuts"])
                at += n

    schema = StructType([*pages.schema.fields, StructField("cuts", ArrayType(IntegerType()))])
    return pages.mapInArrow(run, schema)


def median_threshold(boxes: DataFrame, share: float = 0.6, default: float = 15.0) -> DataFrame:
    """(page, threshold): a share of the median box height."""
    return boxes.groupBy("page").agg(F.coalesce(F.median("height") * share, F.lit(default)).alias("threshold"))


def grouped_lines(boxes: DataFrame) -> DataFrame:
    """(page, text): boxes (page, x, y, text, threshold) read line by line.

    In order of (y, x), a box belongs to the line whose running y is nearer than the
    threshold; the running y is the mean of itself and each new box's.  Lines are joined
    from left to right.  A page's boxes are some hundred at most.
    """

    @F.pandas_udf("string")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(_read_lines)

    box = F.struct("y", "x", "text", "threshold")
    return boxes.groupBy("page").agg(F.sort_array(F.collect_list(box)).alias("b")).select("page", read("b").alias("text"))


def _read_lines(boxes) -> str:
    lines: list[list[tuple[float, str]]] = []
    last = None
    for b in boxes:
        y = b["y"]
        if last is not None and abs(y - last) < b["threshold"]:
            last = (last + y) / 2
        else:
            lines.append([])
            last = y
        lines[-1].append((b["x"], b["text"]))
    return "\n".join(" ".join(t for _, t in sorted(line, key=lambda x: x[0])) for line in lines).strip()
