"""Titled sections of a structured text, with its number and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Titles in the order in which they are looked for.
TITLES = ("Faits", "Procédure", "Dispositif", "Motifs", "Discussion")


def structured(docs: DataFrame, text: str = "text", titles: tuple[str, ...] = TITLES) -> DataFrame:
    """docs with ``sections``: title -> text up to where the section ends.

    A section follows its title and a line break, up to the title's next such place.  The
    first section found ends at the first blank line; each later one only at a line that
    is the title of one found before it.  So the order of titles decides, not the order in
    the text: this is how such texts have been cut so far, and it is kept.
    """
    out = docs
    found: list[str] = []
    for k, title in enumerate(titles):
        parts = F.split(F.col(text), f"(?iu){title}{T.WS}*\n", -1)
        rest = F.get(parts, 1)
        seen = F.concat_ws("|", *(F.when(F.col(f"__s{i}").isNotNull(), F.lit(titles[i])) for i in range(k))) if k else F.lit("")
        out = out.withColumn("__rest", rest).withColumn("__seen", seen)
        cut = F.expr(f"split(__rest, concat('(?imu)^(?:', __seen, ')[\\\\s]*$'), -1)[0]")
        out = out.withColumn(f"__s{k}", F.when(F.col("__rest").isNotNull(), T.strip(cut)))
        found.append(title)
    pairs = F.filter(F.array(*(F.struct(F.lit(t.lower()).alias("key"), F.col(f"__s{i}").alias("value")) for i, t in enumerate(found))), lambda p: p["value"].isNotNull())
    return out.withColumn("sections", F.map_from_entries(pairs)).drop("__rest", "__seen", *(f"__s{i}" for i in range(len(titles))))


