"""Column builders for URLs and page source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, col, lines, norm_url_token, strip

ATTRIBUTE = r"(?is)<(?:a|button|div)(?:\s[^>]*?)?\s(?:href|onclick|data-href)\s*=\s*\"([^\"]*)\""
LONGEST_SLUG = 180


def url_path(c: ColumnLike) -> Column:
    """The path as it stands, escapes included; '' if there is none."""
    return F.regexp_extract(col(c), r"^[A-Za-z][-+.A-Za-z0-9]*://[^/?#]*([^?#]*)", 1)


def segments(c: ColumnLike) -> Column:
    return F.filter(F.split(url_path(c), "/", -1), lambda s: s != "")


def url_decode(c: Column) -> Column:
    """Percent escapes decoded; a plus stays a plus."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def path_words(c: ColumnLike) -> Column:
    """Distinct words of more than three characters of the path's segments that are no numbers."""
    named = F.filter(segments(c), lambda s: ~s.rlike(r"^\p{Nd}+\z"))
    tokens = F.flatten(F.transform(named, lambda s: F.split(strip(norm_url_token(url_decode(s))), r"[\x09-\x0D\x20]+", -1)))
    return F.array_distinct(F.filter(tokens, lambda w: F.length(w) > 3))


def slug(c: ColumnLike) -> Column:
    """Path segments joined by a hyphen, without a last numeric one; cut to 180 characters."""
    parts = F.split(F.regexp_replace(url_path(c), "^/+", ""), "/", -1)
    kept = F.when(F.element_at(parts, -1).rlike(r"^\p{Nd}+\z"), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.substring(F.array_join(kept, "-"), 1, LONGEST_SLUG)


def canonical(c: ColumnLike) -> Column:
    return F.substring_index(col(c), "?", 1)


def base(c: ColumnLike) -> Column:
    """Scheme and host."""
    return F.substring_index(col(c), "/", 3)


def depth(c: ColumnLike) -> Column:
    return F.size(segments(c))


def file_name(c: ColumnLike) -> Column:
    return F.concat(F.translate(F.regexp_replace(col(c), "https://|http://", ""), "/", "_"), F.lit(".txt"))


def visible_text(html: ColumnLike) -> Column:
    """Text of a page by line: comments, scripts, styles and tags are line breaks; the usual references decoded."""
    bare = F.regexp_replace(col(html), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", "\n")
    out = bare
    for name, char in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def long_lines(text: ColumnLike, least: int = 20) -> Column:
    """Trimmed lines of ``least`` characters or more."""
    return F.filter(F.transform(lines(text), strip), lambda l: F.length(l) >= least)


def title(html: ColumnLike) -> Column:
    return strip(F.regexp_extract(col(html), r"(?is)<title[^>]*>([^<]*)</title>", 1))


def description(html: ColumnLike) -> Column:
    return strip(F.regexp_extract(col(html), r"(?is)<meta\s+name=\"description\"\s+content=\"([^\"]*)\"", 1))


def attribute_values(html: ColumnLike) -> Column:
    """Values of href, onclick and data-href of links, buttons and boxes, one per element."""
    return F.regexp_extract_all(col(html), F.lit(ATTRIBUTE), F.lit(1))


def site_links(values: Column, start: Column) -> Column:
    """Distinct absolute links below ``start``; of a quoted call, what stands between its first quotes."""
    web = F.filter(values, lambda v: F.contains(v, F.lit("http")))
    clean = F.transform(web, lambda v: F.when(F.contains(v, F.lit("'")), F.get(F.split(v, "'", -1), 1)).otherwise(v))
    return F.array_distinct(F.filter(clean, lambda v: F.startswith(v, start)))


def pdf_links(values: Column) -> Column:
    return F.filter(values, lambda v: F.endswith(F.lower(v), F.lit(".pdf")))
