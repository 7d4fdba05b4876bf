"""Pages, links and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import web as W
from ..operators.frontier import reachable
from ..registry import register
from .common import q, s_lines, s_strip, table

# the table's URLs with an extra path, escape, number, query: every function then has something to do
_URL = "url || '/Cas-pratique_' || page_id || '/d%C3%A9cision+finale/' || page_id || CASE WHEN page_id % 3 = 0 THEN '?page=' || page_id ELSE '' END"


def _urls(spark, sf_dir):
    p = F.col("page_id").cast("string")
    tail = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("?page="), p)).otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit("/Cas-pratique_"), p, F.lit("/d%C3%A9cision+finale/"), p, tail).alias("url"))


_PATH = f"regexp_extract(u, '^[A-Za-z][-+.A-Za-z0-9]*://[^/?#]*([^?#]*)', 1)"
_FROM = f"(SELECT page_id, {_URL} AS u FROM pages)"
_SEGS = f"list_filter(string_split({_PATH}, '/'), lambda s: s <> '')"
_TOKEN = lambda s: f"replace(replace(regexp_replace(lower({s}), {q('[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_' + T.WS_SET + ']')}, ' ', 'g'), '-', ' '), '_', ' ')"
_WORDS = f"list_sort(list_distinct(list_filter(flatten(list_transform(list_filter({_SEGS}, lambda s: NOT regexp_full_match(s, '[0-9]+')), lambda s: regexp_split_to_array({s_strip(_TOKEN('url_decode(s)'))}, '[\\x09-\\x0D\\x20]+'))), lambda w: length(w) > 3)))"


@register("fn_url_path_words", f"SELECT page_id, array_to_string({_WORDS}, ' ') AS words FROM {_FROM}")
def fn_url_path_words(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", F.array_join(F.sort_array(W.path_words("url")), " ").alias("words"))


@register("agg_url_word_freq", f"SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM {_FROM}) GROUP BY word HAVING count(*) > 50")
def agg_url_word_freq(spark, sf_dir):
    words = _urls(spark, sf_dir).select(F.explode(W.path_words("url")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 50").orderBy(F.desc("n"), "word")


@register("fn_url_slug", f"SELECT page_id, array_to_string(CASE WHEN regexp_full_match(p[-1], '[0-9]+') THEN p[:-2] ELSE p END, '-')[1:180] AS slug FROM (SELECT page_id, string_split(regexp_replace({_PATH}, '^/+', ''), '/') AS p FROM {_FROM})")
def fn_url_slug(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", W.slug("url").alias("slug"))


@register("fn_url_canonical", f"SELECT page_id, split_part(u, '?', 1) AS url FROM {_FROM}")
def fn_url_canonical(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", W.canonical("url").alias("url"))


@register("fn_url_base", f"SELECT page_id, regexp_extract(u, '^[^/]*//[^/]*') AS base FROM {_FROM}")
def fn_url_base(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", W.base("url").alias("base"))


@register("fn_url_depth", f"SELECT base, max(d)::INTEGER AS depth FROM (SELECT regexp_extract(u, '^[^/]*//[^/]*') AS base, len({_SEGS}) AS d FROM {_FROM}) GROUP BY base")
def fn_url_depth(spark, sf_dir):
    return _urls(spark, sf_dir).groupBy(W.base("url").alias("base")).agg(F.max(W.depth("url")).alias("depth"))


@register("fn_url_filename", f"SELECT page_id, replace(replace(replace(u, 'https://', ''), 'http://', ''), '/', '_') || '.txt' AS name FROM {_FROM}")
def fn_url_filename(spark, sf_dir):
    return _urls(spark, sf_dir).select("page_id", W.file_name("url").alias("name"))


@register("flt_url_exclude", "SELECT page_id FROM pages WHERE NOT (contains(url, 'net') OR contains(url, '/legal') OR contains(url, 'cookies'))")
def flt_url_exclude(spark, sf_dir):
    excluded = F.exists(F.array(*map(F.lit, ["net", "/legal", "cookies"])), lambda p: F.contains(F.col("url"), p))
    return table(spark, sf_dir, "pages").where(~excluded).select("page_id")


_BARE = "regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', chr(10), 'g'), '<[^>]*>', chr(10), 'g')"


def _decoded(x: str) -> str:
    for name, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&amp;", "'&'")):
        x = f"replace({x}, {q(name)}, {char})"
    return x


@register("fn_html_text", f"SELECT page_id, len(l)::INTEGER AS n, md5(array_to_string(l, chr(10))) AS digest FROM (SELECT page_id, list_filter(list_transform({s_lines(_decoded(_BARE))}, lambda l: {s_strip('l')}), lambda l: length(l) >= 20) AS l FROM pages)")
def fn_html_text(spark, sf_dir):
    kept = table(spark, sf_dir, "pages").select("page_id", W.long_lines(W.visible_text("html")).alias("l"))
    return kept.select("page_id", F.size("l").alias("n"), F.md5(F.array_join("l", "\n")).alias("digest"))


_DESCRIBED = "replace(html, '</title>', '</title><meta name=\"description\" content=\" Page ' || page_id || '\">')"


@register("fn_html_title_desc", f"SELECT page_id, '### TITLE: ' || {s_strip(chr(40) + 'regexp_extract(h, ' + q('(?is)<title[^>]*>([^<]*)</title>') + ', 1)' + chr(41))} || chr(10) || '### DESCRIPTION: ' || {s_strip(chr(40) + 'regexp_extract(h, ' + q('(?is)<meta name=' + chr(34) + 'description' + chr(34) + ' content=' + chr(34) + '([^' + chr(34) + ']*)' + chr(34)) + ', 1)' + chr(41))} || chr(10) AS header FROM (SELECT page_id, {_DESCRIBED} AS h FROM pages)")
def fn_html_title_desc(spark, sf_dir):
    """The header lines of a saved page: title and description, those that are there."""
    extra = F.concat(F.lit('</title><meta name="description" content=" Page '), F.col("page_id").cast("string"), F.lit('">'))
    h = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("</title>"), extra).alias("h"))
    line = lambda name, v: F.when(v != "", F.concat(F.lit(f"### {name}: "), v, F.lit("\n"))).otherwise("")
    return h.select("page_id", F.concat(line("TITLE", W.title("h")), line("DESCRIPTION", W.description("h"))).alias("header"))


_LINKED = "replace(html, 'href=\"/', 'href=\"https://base.example/')"
_VALUES = "regexp_extract_all(h, '(?is)<(?:a|button|div)(?:\\s[^>]*?)?\\s(?:href|onclick|data-href)\\s*=\\s*\"([^\"]*)\"', 1)"


def _linked(spark, sf_dir):
    """Pages whose relative links are made absolute."""
    return table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit('href="/'), F.lit('href="https://base.example/')).alias("h"))


@register("fn_html_links", f"SELECT page_id, array_to_string(list_sort(list_distinct(list_filter({_VALUES}, lambda v: contains(v, 'http') AND starts_with(v, 'https://base.example')))), ' ') AS links FROM (SELECT page_id, {_LINKED} AS h FROM pages)")
def fn_html_links(spark, sf_dir):
    links = W.site_links(W.attribute_values("h"), F.lit("https://base.example"))
    return _linked(spark, sf_dir).select("page_id", F.array_join(F.sort_array(links), " ").alias("links"))


@register("fn_pdf_links", f"SELECT page_id, len(list_filter({_VALUES}, lambda v: ends_with(lower(v), '.pdf')))::INTEGER AS n FROM (SELECT page_id, replace(html, 'href=\"/t', 'href=\"/t.PDF\" x=\"') AS h FROM pages)")
def fn_pdf_links(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit('href="/t'), F.lit('href="/t.PDF" x="')).alias("h"))
    return h.select("page_id", F.size(W.pdf_links(W.attribute_values("h"))).alias("n"))


@register("flt_link_follow", f"SELECT DISTINCT v AS link FROM (SELECT unnest({_VALUES}) AS v FROM (SELECT {_LINKED} AS h FROM pages)) WHERE v <> '' AND starts_with(v, 'https://base.example') AND NOT contains(v, 'mailto:') AND NOT contains(v, 'javascript:') AND NOT contains(v, '#') AND v NOT IN (SELECT 'https://base.example/' || lower(lang) FROM documents)")
def flt_link_follow(spark, sf_dir):
    """Links to follow: below the base, no mail, script or fragment, not visited."""
    links = _linked(spark, sf_dir).select(F.explode(W.attribute_values("h")).alias("link")).distinct()
    bad = F.exists(F.array(*map(F.lit, ["mailto:", "javascript:", "#"])), lambda p: F.contains(F.col("link"), p))
    visited = table(spark, sf_dir, "documents").select(F.concat(F.lit("https://base.example/"), F.lower("lang")).alias("link")).distinct()
    return links.where((F.col("link") != "") & F.startswith("link", F.lit("https://base.example")) & ~bad).join(visited, "link", "left_anti")


_EDGES = "(SELECT page_id AS src, (page_id * 7 + k * k + 1) % (SELECT count(*) FROM pages) AS dst FROM pages, range(1, 3) AS v(k))"


@register("link_frontier", f"WITH RECURSIVE e AS MATERIALIZED {_EDGES}, r(url, depth) AS (SELECT 0::BIGINT, 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON r.url = e.src WHERE depth < 10) SELECT url, min(depth)::INTEGER AS depth FROM r GROUP BY url")
def link_frontier(spark, sf_dir):
    """Breadth-first depth of every page that the start leads to."""
    pages = table(spark, sf_dir, "pages").select("page_id")
    n = pages.count()
    k = F.explode(F.array(F.lit(1), F.lit(2)))
    edges = pages.select(F.col("page_id").alias("src"), k.alias("k")).select("src", ((F.col("src") * 7 + F.col("k") * F.col("k") + 1) % n).alias("dst"))
    return reachable(edges, spark.createDataFrame([(0,)], "url long"))
