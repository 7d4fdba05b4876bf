"""Column builders for similarity and error metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, col, count_of


def character_error_rate(ref: ColumnLike, hyp: ColumnLike) -> Column:
    """Edit distance in characters per character of the reference (one at least)."""
    return F.levenshtein(col(ref), col(hyp)) / F.greatest(F.length(col(ref)), F.lit(1))


BAND = 24


def edit_distance(a: ColumnLike, b: ColumnLike) -> Column:
    """Edit distance in characters: within a band first, which costs length times band, and in full only beyond it."""
    near = F.nullif(F.levenshtein(col(a), col(b), BAND), F.lit(-1))
    return F.when(col(a) == col(b), F.lit(0)).otherwise(F.coalesce(near, F.levenshtein(col(a), col(b))))


def word_edit_distance(ref: ColumnLike, hyp: ColumnLike) -> Column:
    """Edit distance between two arrays, a row of the distance matrix at a time."""
    ref, hyp = col(ref), col(hyp)

    def next_row(row: Column, item: Column) -> Column:
        # row[j] is the distance to hyp's first j items; the new row grows from its left
        def grow(new: Column, j: Column) -> Column:
            swap = F.element_at(row, j) + F.when(F.element_at(hyp, j) == item, 0).otherwise(1)
            best = F.least(swap, F.element_at(row, j + 1) + 1, F.element_at(new, -1) + 1)
            return F.concat(new, F.array(best))

        first = F.array(F.element_at(row, 1) + 1)
        return F.when(F.size(hyp) == 0, first).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(hyp), F.lit(1))), first, grow))

    start = F.transform(F.sequence(F.lit(0), F.size(hyp)), lambda x: x)
    return F.element_at(F.aggregate(ref, start, next_row), -1)


def set_jaccard(a: ColumnLike, b: ColumnLike) -> Column:
    """Shared by all distinct items of two arrays; 1 if both are empty."""
    union = F.size(F.array_union(col(a), col(b)))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(col(a), col(b))) / union)


STRUCTURE = ("words", "paragraphs", "uppers", "points", "exclams", "quests")
UPPER = r"[A-ZÉÈÀÙÂÊÎÔÛÇ]"


def structure(c: ColumnLike, words: Column | None = None) -> dict[str, Column]:
    """Counts of words, paragraphs, capitals and sentence marks; ``words`` if they are counted already."""
    text = col(c)
    blank = r"^[\x09-\x0D\x1C-\x20\x{85}\x{A0}]*\z"
    out = {
        "words": F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+")) if words is None else words,
        "paragraphs": F.size(F.filter(F.split(text, "\n\n", -1), lambda p: ~p.rlike(blank))),
        "uppers": F.length(text) - F.length(F.regexp_replace(text, UPPER, "")),
        "points": count_of(text, "."),
        "exclams": count_of(text, "!"),
        "quests": count_of(text, "?"),
    }
    return {k: v.cast("long") for k, v in out.items()}


def symmetric_ratio(hyp: Column, ref: Column) -> Column:
    """min(r, 1/r) of r = hyp / ref; 0 where either is 0, also where both are."""
    return F.when((ref == 0) | (hyp == 0), F.lit(0.0)).otherwise(F.least(hyp / ref, ref / hyp))


def ratios_mean(hyp: dict[str, Column], ref: dict[str, Column]) -> Column:
    """Mean symmetric ratio of words, paragraphs, capitals, full stops and exclamation marks."""
    return sum((symmetric_ratio(hyp[k], ref[k]) for k in STRUCTURE[:5]), F.lit(0.0)) / F.lit(5.0)


def intersection_over_union(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """IoU of two boxes x0, y0, x1, y1; the union is kept off zero by 1e-6."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(zero, F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    return w * h / (area(a) + area(b) - w * h + 1e-6)
