"""Column builders for text: white space, lines, words, normalisation, segmentation.

Character classes are spelt out, because ``\\s``, ``\\w`` and ``\\b`` mean different sets in
different regular-expression engines.  Patterns here are valid for Java and for RE2.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

#: white space as Unicode text processing understands it (str.isspace), inside and as a class
WS_SET = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_SET}]"
NOT_WS = f"[^{WS_SET}]"
#: the same characters, one by one
WS_CHARS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
#: white space that is not one plain space, which collapse() leaves as it is; for Java, which asks a class's ranges
#: one by one: nearly all characters lie outside the two ranges that it asks first
WS_UNEVEN = f"[\\x09-\\x1F\\x{{85}}-\\x{{3000}}&&[{WS_SET.replace('\\x1C-\\x20', '\\x1C-\\x1F')}]]{WS}*|\\x20[\\x09-\\x20\\x{{85}}-\\x{{3000}}&&{WS}]+"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: the same for Java, by the same means
_LINE_END_JAVA = r"\r\n|[\n-\x1E\x{85}-\x{2029}&&[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]]"
WORD = r"[\p{L}\p{N}_]+"
#: words with inner apostrophes kept
WORD_FR = r"[0-9\p{L}]+(?:'[0-9\p{L}]+)*"
STRIP = f"^{WS}+|{WS}+\\z"
SENTENCE_END = f"([.?!]){WS}+"
MARK = "\x01"

ACCENTED = "àâäáãåçéèêëîïíìôöóòõùûüúÿñÀÂÄÁÃÅÇÉÈÊËÎÏÍÌÔÖÓÒÕÙÛÜÚŸÑ"
PLAIN = "aaaaaaceeeeiiiiooooouuuuynAAAAAACEEEEIIIIOOOOOUUUUYN"


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnLike) -> Column:
    return F.btrim(col(c), F.lit(WS_CHARS))


def once(c: Column, function: Callable[[Column], Column]) -> Column:
    """function(c), with c computed once however often the function uses it: a name of transform() stands for it."""
    return F.get(F.transform(F.array(c), function), F.lit(0))


def collapse(c: ColumnLike) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(col(c), WS_UNEVEN, " ")


def lines(c: ColumnLike) -> Column:
    """Array of lines, at any line boundary; a final boundary opens no line."""
    def closed(whole: Column) -> Column:
        ends_open = (F.size(whole) > 0) & (F.element_at(whole, -1) == "")
        return F.when(ends_open, F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0)))).otherwise(whole)

    return once(F.split(col(c), _LINE_END_JAVA, -1), closed)


def words(c: ColumnLike) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(WORD), F.lit(0))


def words_fr(c: ColumnLike) -> Column:
    return F.regexp_extract_all(col(c), F.lit(WORD_FR), F.lit(0))


def fields(c: ColumnLike) -> Column:
    """Array of the maximal runs without white space; a class of all other characters would cost five times as much to match."""
    return F.filter(F.split(strip(collapse(c)), " ", -1), lambda x: x != "")


def letters(c: ColumnLike) -> Column:
    """Number of letters."""
    return F.length(F.regexp_replace(col(c), r"[^\p{L}]+", ""))


def letters_digits(c: ColumnLike) -> Column:
    return F.length(F.regexp_replace(col(c), r"[^\p{L}\p{N}]+", ""))


def count_of(c: ColumnLike, char: str) -> Column:
    """Occurrences of one character."""
    return F.length(col(c)) - F.length(F.replace(col(c), F.lit(char), F.lit("")))


def replace_all(c: ColumnLike, pairs: Sequence[tuple[str, str]]) -> Column:
    out = col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def fold_ascii(c: ColumnLike) -> Column:
    """Accents taken off, ligatures opened, whatever else is not ASCII dropped; case stays."""
    opened = replace_all(F.translate(col(c), ACCENTED, PLAIN), [("œ", "oe"), ("Œ", "Oe"), ("æ", "ae"), ("Æ", "Ae"), ("ß", "ss")])
    return F.regexp_replace(opened, r"[^\x00-\x7F]", "")


# What each normaliser puts for what.
QUOTES = [("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"')]
GUILLEMETS = [("«", '"'), ("»", '"')]
DASHES = [("–", "-"), ("—", "-")]
LIGATURES = [("œ", "oe"), ("Œ", "Oe"), ("æ", "ae"), ("Æ", "Ae")]


def norm_metric_composed(c: ColumnLike) -> Column:
    """Normalisation before metrics, of text that is in NFKC already: quotes, dashes, ligatures, end-of-line hyphens, spaces, case."""
    opened = replace_all(col(c), QUOTES + DASHES + LIGATURES)
    joined = F.regexp_replace(opened, f"-{WS}*\n", "")
    return F.coalesce(F.lower(collapse(strip(joined))), F.lit(""))


def norm_crop_composed(c: ColumnLike) -> Column:
    """Normalisation of crop labels, of text that is in NFKC already; a left single quote stays, and so does case."""
    pairs = [p for p in QUOTES if p[0] != "‘"] + DASHES + LIGATURES
    return F.coalesce(collapse(strip(replace_all(col(c), pairs))), F.lit(""))


def norm_typo(c: ColumnLike) -> Column:
    """Typography: quotes, ellipsis, dashes, the word ``oe`` as ligature, all white space to one space."""
    plain = replace_all(col(c), [*QUOTES, *GUILLEMETS, ("…", "..."), *DASHES])
    return strip(collapse(replace_literal(plain, "oe", "œ")))


def norm_quotes(c: ColumnLike) -> Column:
    return strip(collapse(replace_all(col(c), QUOTES + GUILLEMETS)))


def norm_web_line(c: ColumnLike) -> Column:
    """One line of a page, of text in NFKC already; only the right single quote and guillemets change."""
    return F.array_join(fields(replace_all(col(c), [("’", "'"), *GUILLEMETS])), " ")


def norm_url_token(c: ColumnLike) -> Column:
    """Lower case; what is neither word nor space becomes a space, and so does an underscore."""
    return F.translate(F.regexp_replace(F.lower(col(c)), rf"[^\p{{L}}\p{{N}}_{WS_SET}]", " "), "-_", "  ")


EDGE_LEFT, EDGE_RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def replace_word(c: ColumnLike, pattern: str, new: str) -> Column:
    """Replace a pattern between word edges of Unicode words."""
    return F.regexp_replace(col(c), EDGE_LEFT + pattern + EDGE_RIGHT, new.replace("$", r"\$"))


def replace_literal(c: ColumnLike, word: str, new: str) -> Column:
    """replace_word() of a word without pattern signs; texts that do not hold it are not searched, nor are places for its edges."""
    pattern = rf"{word}(?<![\p{{L}}\p{{N}}_]{word}){EDGE_RIGHT}"
    return once(col(c), lambda t: F.when(F.contains(t, F.lit(word)), F.regexp_replace(t, pattern, new.replace("$", r"\$"))).otherwise(t))


# Characters of labels and what stands for them; those without an entry stay.
LABEL_ONE = {"−": "-", "‐": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "“": '"', "”": '"', "‘": "'", "’": "'", "⁄": "/", "∗": "*", "÷": "/", "×": "x", "♯": "#", "Ø": "O"}
LABEL_MANY = {"…": "...", "©": "(c)", "®": "(R)", "Δ": "Delta", "Λ": "Lambda", "π": "pi", "λ": "lambda", "γ": "gamma", "ν": "nu", "η": "eta", "φ": "phi", "Σ": "SUM", "∑": "SUM"}
LABEL_DROP = r"[\x00-\x1F\x{A8}\x{E000}-\x{F8FF}\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}]"


def norm_label(c: ColumnLike) -> Column:
    """Label characters mapped to plain ones; private-use, control, Chinese and Japanese characters dropped."""
    mapped = F.translate(col(c), "".join(LABEL_ONE), "".join(LABEL_ONE.values()))
    return F.regexp_replace(replace_all(mapped, list(LABEL_MANY.items())), LABEL_DROP, "")


def split_after(c: ColumnLike, end: str = SENTENCE_END) -> Column:
    """Array of pieces, cut behind a sentence's end where white space follows, which goes."""
    return F.split(F.regexp_replace(col(c), end, "$1" + MARK), MARK, -1)


def short_units(c: ColumnLike, most_words: int = 30) -> Column:
    """split_after(), with pieces of more than ``most_words`` words cut after every so many."""
    # possessive, and tried only where there are enough words: a failed search is quadratic
    every = f"((?:{NOT_WS}++{WS}++){{{most_words}}})"

    def cut(s: Column) -> Column:
        return F.when(F.size(fields(s)) >= most_words, F.split(F.regexp_replace(s, every, "$1" + MARK), MARK, -1)).otherwise(F.array(s))

    return F.flatten(F.transform(split_after(c), cut))


def sentences(c: ColumnLike) -> Column:
    """Sentences: line breaks within a paragraph are spaces, blank lines end paragraphs; trimmed, without empty ones."""
    no_cr = F.regexp_replace(F.replace(col(c), F.lit("\r"), F.lit("")), r"\n{3,}", "\n\n")
    joined = F.regexp_replace(no_cr, r"([^\n])\n(?=[^\n])", "$1 ")
    blocks = F.split(joined, r"\n{2,}", -1)
    parts = F.flatten(F.transform(blocks, lambda b: split_after(strip(b))))
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def strip_control(c: ColumnLike) -> Column:
    return strip(F.translate(col(c), "\t\r\n", "   "))


def dehyphenate(c: ColumnLike) -> Column:
    """Words cut by a hyphen and white space joined; a hyphen alone becomes a space."""
    word = r"[\p{L}\p{N}_]"

    def joined(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, rf"({word})-{WS}+({word})", "$1$2"), rf"({WS}|^)-({WS}|\z)", " ")

    return once(col(c), lambda t: F.when(F.contains(t, F.lit("-")), joined(t)).otherwise(t))


def split_long_lines(c: ColumnLike, longest: int = 800) -> Column:
    """Text whose lines of more than ``longest`` characters are cut at sentence ends; trimmed, without blank ones."""
    each = F.transform(lines(c), strip)
    cut = F.flatten(F.transform(each, lambda l: F.when(F.length(l) > longest, split_after(l)).otherwise(F.array(l))))
    return F.array_join(F.filter(cut, lambda s: strip(s) != ""), "\n")


def dedup_lines(c: ColumnLike) -> Column:
    """Trimmed lines without blank and repeated ones, in order of first occurrence."""
    return F.array_join(F.array_distinct(F.filter(F.transform(F.split(col(c), "\n", -1), strip), lambda s: s != "")), "\n")


def upper_first(c: ColumnLike) -> Column:
    """The first letter in upper case if it is one of a to z."""
    first = F.substring(col(c), 1, 1)
    return F.when(first.rlike("^[a-z]"), F.concat(F.upper(first), F.expr("substring(%s, 2)" % c) if isinstance(c, str) else F.substr(col(c), F.lit(2)))).otherwise(col(c))
