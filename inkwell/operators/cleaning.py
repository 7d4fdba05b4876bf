"""The steps of the post-processing pipeline on batches of texts, each an Arrow UDF on a column.

They give what the column builders of the same names do (functions/text, filters; the tests hold
one against the other).  Those search every character for each class of white space and letters,
one range after the other; Python's own text functions ask a table.  Steps that follow each other
are run in one pass of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T
from . import filters

PLAIN = [*T.QUOTES, *T.GUILLEMETS, ("…", "..."), *T.DASHES]
#: digits of the patterns are those of ASCII
_BEGINS, _IS, _HOLDS = (re.compile(p.replace(r"\d", "[0-9]").replace("(?iu)", "(?i)")) for p in (filters._BEGINS, filters._IS, filters._HOLDS))
_LONG_END = re.compile(r"([.?!])\s+")
_CUT_WORD, _LONE_HYPHEN = re.compile(r"(\w)-\s+(\w)"), re.compile(r"(\s|^)-(\s|\Z)")


def _literals(pairs: list[tuple[str, str]]) -> list[tuple[str, re.Pattern, str]]:
    return [(old, re.compile(rf"(?<!\w){re.escape(old)}(?!\w)"), new.replace("\\", r"\\")) for old, new in pairs]


_LIGATURE, _MISREAD = _literals([("oe", "œ")]), _literals(filters.MISREAD)


def _respelt(t: str, literals: list[tuple[str, re.Pattern, str]]) -> str:
    """Words put for words; a text that does not hold one is not searched for its edges."""
    for old, pattern, new in literals:
        if old in t:
            t = pattern.sub(new, t)
    return t


def _share(s: str, kind: Callable[[str], bool]) -> int:
    """How many characters are of a kind (str.isalpha, str.isalnum), which spaces, commas and stops are not."""
    # most lines hold nothing else but spaces, commas and stops
    plain = s.replace(" ", "").replace(",", "").replace(".", "")
    return len(plain) if kind(plain) else sum(map(kind, plain))


def _typography(t: str) -> str:
    for old, new in PLAIN:
        t = t.replace(old, new)
    return " ".join(_respelt(t, _LIGATURE).split())


def _pieces(line: str, longest: int) -> list[str]:
    return _LONG_END.sub("\\1" + T.MARK, line).split(T.MARK) if len(line) > longest else [line]


def _noise(line: str) -> bool:
    """Whether filters.noise_reason() has a reason."""
    size = len(line)
    if size > 16 and _share(line, str.isalpha) / (size + 1e-5) < 0.45:
        return True
    return size < 4 or bool(_BEGINS.match(line[: filters._BEGINNING]) or (size <= 16 and _IS.match(line)) or ("@" in line and _HOLDS.search(line)))


def _purged(t: str) -> str:
    return "\n".join(line for line in map(str.strip, t.splitlines()) if not _noise(line))


def _keeps(p: str) -> bool:
    """Whether filters.symbol_paragraphs() keeps a paragraph."""
    return len(p) >= 5 and not (len(p) > 12 and _share(p, str.isalnum) / len(p) < 0.5)


def _capital(s: str) -> str:
    return s[0].upper() + s[1:] if "a" <= s[:1] <= "z" else s


def _cleaned(t: str) -> str:
    if "-" in t:
        t = _LONE_HYPHEN.sub(" ", _CUT_WORD.sub(r"\1\2", t))
    lines = " ".join(line for line in map(str.strip, t.split("\n")) if line)
    first, *others = _LONG_END.sub("\\1\n", lines).split("\n")
    return "\n".join(dict.fromkeys(p for p in map(str.strip, (first, *map(_capital, others))) if _keeps(p)))


def _step(each: Callable[[str], str]) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def step(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else each(t))

    return step


def typography(c: Column) -> Column:
    """T.norm_typo()."""
    return _step(_typography)(c)


def misreadings(c: Column, custom: list[tuple[str, str]] | None = None) -> Column:
    """filters.correct_misreadings(); the custom patterns are Spark's."""
    out = _step(lambda t: _respelt(t, _MISREAD))(c)
    for pattern, new in custom or []:
        out = F.regexp_replace(out, pattern, new)
    return out


def split_long(c: Column, longest: int = 800) -> Column:
    """T.split_long_lines()."""
    return _step(lambda t: "\n".join(p for line in t.splitlines() for p in _pieces(line.strip(), longest) if p.strip()))(c)


def purge(c: Column) -> Column:
    """filters.purge_noise()."""
    return _step(_purged)(c)


def clean(c: Column) -> Column:
    """filters.clean_paragraphs()."""
    return _step(_cleaned)(c)


def dedup(c: Column) -> Column:
    """T.dedup_lines()."""
    return _step(lambda t: "\n".join(dict.fromkeys(line for line in map(str.strip, t.split("\n")) if line)))(c)
