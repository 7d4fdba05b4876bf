"""Line, paragraph and replacement filters over text, without a shuffle: arrays of lines stay in their row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# What marks a line as noise, wherever case-insensitively found in it.
NOISE = [
    r"^accéder au cours", r"^recommandé pour toi", r"^plus de :", r"^document[ :]", r"^tableau comparatif", r"^exercices > séance",
    r"^fiche d'arrêt", r"^résumé poétique", r"^contact & aide", r"^questions-?cours", r"^offres d'emplois", r"^mentions légales",
    r"^politique de confidentialité", r"@studocu", r"^(\d{1,2}%|\d{1,2} \%)$", r"^=+$", r"^\s*-+\s*$",
]
NOISE_PATTERN = "(?i)" + "|".join(NOISE)
#: the same for Java, which tries them at every place of a line: how a line begins, what it is as a whole, what it holds
_BEGINS, _IS, _HOLDS = ("(?iu)" + "|".join(n for n in NOISE if kind(n)) for kind in (
    lambda n: n[0] == "^" and n[-1] != "$", lambda n: n[0] == "^" and n[-1] == "$", lambda n: n[0] != "^"))
#: characters that tell how a line begins: more than any of NOISE has
_BEGINNING = 64
# French words too common to be called rare.
STOPWORDS = (
    "le la et de du en à les des un une dans au pour par sur avec ou se ce il elle nous vous je tu ils elles "
    "son sa ses leur leurs plus a est que qui ne pas mais comme aussi"
).split()
TRIVIAL = r"^[.,; }\]\[{)(]*\z"


def noise_reason(line: Column) -> Column:
    """Why a trimmed line is dropped, null if it stays: few letters in a long line, too short, or a noise pattern."""
    size = F.length(line)
    # what a line is as a whole has no letters, so it is looked for in lines that "letters" does not judge; what it holds begins with @
    noise = F.substring(line, 1, _BEGINNING).rlike(_BEGINS) | ((size <= 16) & line.rlike(_IS)) | (F.contains(line, F.lit("@")) & line.rlike(_HOLDS))
    return (
        F.when(size == 0, "empty")
        .when((size > 16) & (T.letters(line) / (size + 1e-5) < 0.45), "letters")
        .when(size < 4, "short")
        .when(noise, "pattern")
    )


def purge_noise(text: Column) -> Column:
    """The text's trimmed lines that noise_reason() keeps."""
    each = F.transform(T.lines(text), T.strip)
    return F.array_join(F.filter(each, lambda l: noise_reason(l).isNull()), "\n")


def noise_lines(text: Column) -> Column:
    """Array of (line, reason) of the dropped lines, blank ones aside."""
    each = F.transform(T.lines(text), T.strip)
    marked = F.transform(each, lambda l: F.struct(l.alias("line"), noise_reason(l).alias("reason")))
    return F.filter(marked, lambda s: s["reason"].isNotNull() & (s["reason"] != "empty"))


def symbol_paragraphs(paragraphs: Column) -> Column:
    """Trimmed paragraphs without repeated ones, those of under 5 characters and long ones of mostly symbols."""
    each = F.transform(paragraphs, T.strip)
    size = F.length
    return F.array_distinct(F.filter(each, lambda p: (size(p) >= 5) & ~((size(p) > 12) & (T.letters_digits(p) / size(p) < 0.5))))


def useful_replacement(old: Column, new: Column) -> Column:
    """Whether a correction changes something: neither side empty, equal or only brackets and stops."""
    return (old != "") & (new != "") & (old != new) & ~old.rlike(TRIVIAL) & ~new.rlike(TRIVIAL)


# Frequent misreadings and what they stand for, applied in this order.
MISREAD = [
    ("a'est", "c'est"), ("aride", "article"), ("un'a", "n'a"), ("maïs", "mais"), ("a'agir", "s'agit"), ("de'à", "de à"),
    ("peureux", "Peureux"), ("RERREEREEMEE", "ERREUR"), ("safran, graisse", "exemple"), ("je peureux", "je peux"), ("a'il", "s'il"), ("a'est-à-dire", "c'est-à-dire"),
]


def correct_misreadings(text: Column, custom: list[tuple[str, str]] | None = None) -> Column:
    """The fixed replacements between word edges, then the custom (pattern, replacement) pairs, in order."""
    for old, new in MISREAD:
        text = T.replace_literal(text, old, new)
    for pattern, new in custom or []:
        text = F.regexp_replace(text, pattern, new)
    return text


def clean_paragraphs(text: Column) -> Column:
    """Hyphens joined, lines joined, a sentence per line, capitals, then symbol_paragraphs()."""
    lines = F.filter(F.transform(F.split(T.dehyphenate(text), "\n", -1), T.strip), lambda l: l != "")
    per_sentence = F.split(F.regexp_replace(F.array_join(lines, " "), f"([.!?]){T.WS}+", "$1\n"), "\n", -1)
    spelt = F.transform(per_sentence, lambda s, i: F.when(i == 0, s).otherwise(capital(s)))
    return F.array_join(symbol_paragraphs(spelt), "\n")


def capital(s: Column) -> Column:
    """The first letter in upper case, if it is one of a to z."""
    head = F.substring(s, 1, 1)
    return F.when(head.rlike("^[a-z]"), F.concat(F.upper(head), F.substr(s, F.lit(2)))).otherwise(s)
