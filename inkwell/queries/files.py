"""Sources and sinks, by way of files that the queries write themselves from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dataset as D
from ..registry import register
from ..sources import appends as A
from ..sources import readers as R
from ..sources import sinks as W
from ..sources.scratch import scratch
from .common import docs, q, s_strip, table

_LINE = "'p/' || doc_id || '.png' || (CASE doc_id % 4 WHEN 0 THEN chr(9) WHEN 1 THEN '  ' WHEN 2 THEN chr(9) || ' a' || chr(9) ELSE '' END) || (CASE WHEN doc_id % 4 = 3 THEN '' ELSE source || ' ' || lang END)"


def _lines() -> F.Column:
    d = F.col("doc_id")
    gap = F.when(d % 4 == 0, "\t").when(d % 4 == 1, "  ").when(d % 4 == 2, "\t a\t").otherwise("")
    return F.concat(F.lit("p/"), d.cast("string"), F.lit(".png"), gap, F.when(d % 4 == 3, "").otherwise(F.concat_ws(" ", "source", "lang")))


def _page_json() -> F.Column:
    """An annotation per document, as JSON; every seventh is broken, every fifth has its category elsewhere or nowhere."""
    d = F.col("doc_id")
    cells = F.transform(T.words("text"), lambda w, i: F.struct(F.when(i == 2, F.lit("")).otherwise(w).alias("text"), F.array(d.cast("double") % 50 + i * 10, (i % 2).cast("double") * 20, F.lit(8.0), F.lit(9.0)).alias("bbox")))
    meta = F.struct(F.concat(F.lit("scan_"), d.cast("string"), F.lit(".pdf")).alias("original_filename"), F.md5(d.cast("string")).alias("page_hash"), F.when(d % 5 != 0, F.col("source")).alias("doc_category"))
    good = F.to_json(F.struct(meta.alias("metadata"), cells.alias("cells")))
    return F.when(d % 7 == 0, F.lit("[broken")).otherwise(good)


@register("src_text", f"SELECT item_id, md5({s_strip('text')}) AS digest FROM benchmark")
def src_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written one file each and read back whole."""
    path = scratch(spark, "texts")
    W.write_texts(table(spark, sf_dir, "benchmark").select("item_id", "text"), path, "item_id")
    raw = spark.read.option("lineSep", "\x1e").text(path)
    return raw.select(F.col("item_id").cast("long").alias("item_id"), F.md5(T.strip("value")).alias("digest"))


register("sink_text", f"SELECT item_id, md5({s_strip('text')}) AS digest FROM benchmark")(src_text)


@register("src_text_lossy", f"SELECT item_id, md5({s_strip('text')}) AS digest FROM benchmark")
def src_text_lossy(spark, sf_dir):
    """Files with a stray byte in them, which is left out on reading."""
    path = scratch(spark, "stray")
    stray = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    W.write_texts(table(spark, sf_dir, "benchmark").select("item_id", stray.alias("text")), path, "item_id")
    rows = R.lossy_texts(spark, path, folder="item_id")
    return rows.select(F.col("folder").cast("long").alias("item_id"), F.md5("text").alias("digest"))


_CSV = "doc_id long, source string, ratio double"
_CSV_SQL = "SELECT doc_id, source, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE (doc_id % 100) / 8.0::DOUBLE END AS ratio FROM documents"


def _csv_rows(spark, sf_dir):
    d = F.col("doc_id")
    return docs(spark, sf_dir).select("doc_id", "source", F.when(d % 9 != 0, (d % 100) / F.lit(8.0)).alias("ratio"))


@register("src_csv_comma", _CSV_SQL)
def src_csv_comma(spark, sf_dir):
    path = scratch(spark, "csv")
    W.overwrite_csv(_csv_rows(spark, sf_dir), path)
    return R.delimited(spark, path, _CSV)


@register("src_csv_semicolon", _CSV_SQL)
def src_csv_semicolon(spark, sf_dir):
    path = scratch(spark, "csv")
    W.overwrite_csv(_csv_rows(spark, sf_dir), path, ";")
    return R.delimited(spark, path, _CSV, ";")


@register("sink_csv_overwrite", _CSV_SQL)
def sink_csv_overwrite(spark, sf_dir):
    """Two full rewrites: the second is all that stays."""
    path = scratch(spark, "csv")
    W.overwrite_csv(_csv_rows(spark, sf_dir).limit(0), path)
    W.overwrite_csv(_csv_rows(spark, sf_dir), path)
    return R.delimited(spark, path, _CSV)


@register("sink_csv_append_header_once", "SELECT doc_id, source FROM documents UNION ALL SELECT item_id, 'benchmark' FROM benchmark")
def sink_csv_append_header_once(spark, sf_dir):
    """Rows of two runs appended under the header of the first, and read back; the second run is started twice."""
    path = scratch(spark, "appended")
    A.append_once(docs(spark, sf_dir).select("doc_id", "source"), path, "documents")
    for _ in range(2):
        A.append_once(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("source")), path, "benchmark")
    return A.appended(spark, path, "doc_id long, source string")


@register("src_csv_positional", "SELECT url, 'https://x' AS host FROM pages WHERE page_id % 3 = 0")
def src_csv_positional(spark, sf_dir):
    """Lines of exactly two fields; others are passed over."""
    path = scratch(spark, "positional")
    p = F.col("page_id") % 3
    line = F.concat(F.col("url"), F.when(p == 0, ";https://x").when(p == 1, "").otherwise(";a;b"))
    table(spark, sf_dir, "pages").select(line.alias("value")).write.text(path)
    rows = R.positional(spark, path, ";", 2, 2)
    return rows.select(F.get("fields", 0).alias("url"), F.get("fields", 1).alias("host"))


@register("src_tsv_first_tab", f"""SELECT CASE WHEN doc_id % 4 = 3 THEN NULL ELSE 'p/' || doc_id || '.png' END AS path,
  CASE WHEN doc_id % 4 = 3 THEN NULL WHEN doc_id % 4 = 2 THEN 'a' || chr(9) || source || ' ' || lang ELSE source || ' ' || lang END AS label FROM documents""")
def src_tsv_first_tab(spark, sf_dir):
    path = scratch(spark, "list")
    docs(spark, sf_dir).select(_lines().alias("value")).write.text(path)
    return R.train_list(spark, path)


_CELLS_SQL = f"(SELECT doc_id, source, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE list_filter(list_transform(regexp_extract_all(lower(text), {q(T.WORD)}), lambda w, i: CASE WHEN i = 3 THEN '' ELSE w END), lambda w: w <> '') END AS c FROM documents)"


@register("src_json_nested", "SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE 'scan_' || doc_id || '.pdf' END AS original, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE md5(doc_id::VARCHAR) END AS hash FROM documents")
def src_json_nested(spark, sf_dir):
    raw = docs(spark, sf_dir).select("doc_id", _page_json().alias("value"))
    return R.annotations(raw).select("doc_id", F.col("page.metadata.original_filename").alias("original"), F.col("page.metadata.page_hash").alias("hash"))


@register("src_json_cells_text", f"SELECT doc_id, array_to_string(c, chr(10)) AS text, CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 THEN 'unknown' ELSE source END AS category FROM {_CELLS_SQL}")
def src_json_cells_text(spark, sf_dir):
    raw = docs(spark, sf_dir).select("doc_id", _page_json().alias("value"))
    return R.annotations(raw).select("doc_id", R.cells_text().alias("text"), R.category().alias("category"))


@register("src_json_map", "SELECT doc_id, 'lang' AS key, lang AS label FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents")
def src_json_map(spark, sf_dir):
    raw = docs(spark, sf_dir).select("doc_id", F.to_json(F.struct(F.struct("lang", "source").alias("labels"))).alias("value"))
    return R.label_rows(raw).select("doc_id", "key", "label")


@register("src_dir_glob")
def src_dir_glob(spark, sf_dir):
    """Names of the files of some extensions under a folder."""
    return R.listing(spark, sf_dir, ("parquet",), recursive=False).select("name").distinct().orderBy("name")


@register("src_pdf_text")
def src_pdf_text(spark, sf_dir):
    """The plug point for extractors of page images: a provider turns bytes into text; here a stub that decodes UTF-8."""
    from ..sources.extractors import extracted, utf8_provider

    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    return extracted(pages, utf8_provider).select("page_id", F.length("text").cast("long").alias("n"))


@register("src_html_page", "SELECT page_id, url, length(html)::BIGINT AS n FROM pages")
def src_html_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", F.length("html").cast("long").alias("n"))


@register("src_hf_dataset", "SELECT doc_id, md5(text) AS digest FROM documents")
def src_hf_dataset(spark, sf_dir):
    """Any Parquet corpus with one text column, here under the column name of the public law corpus."""
    articles = docs(spark, sf_dir).select("doc_id", F.col("text").alias("article_contenu_text"))
    return articles.select("doc_id", F.md5("article_contenu_text").alias("digest"))


@register("src_lexicon", f"SELECT t AS token FROM (SELECT {s_strip('l')} AS t FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM benchmark)) WHERE t <> '' UNION ALL SELECT ' '")
def src_lexicon(spark, sf_dir):
    path = scratch(spark, "lexicon")
    table(spark, sf_dir, "benchmark").select(F.concat(F.lit("  "), "text").alias("value")).write.text(path)
    return R.lexicon(spark, path, with_space=True)


@register("src_regex_map", "SELECT doc_id, md5(replace(replace(text, 'the', 'THE'), 'er', 'ER')) AS digest FROM documents")
def src_regex_map(spark, sf_dir):
    """A correction file read and folded into one expression."""
    path = scratch(spark, "map")
    spark.createDataFrame([("the,THE\nnothing here\ner,ER",)], "value string").coalesce(1).write.text(path)
    out = F.col("text")
    for pattern, new in R.correction_map(spark, path):
        out = F.regexp_replace(out, pattern, new)
    return docs(spark, sf_dir).select("doc_id", F.md5(out).alias("digest"))


_TOLD = "SELECT doc_id, lang, md5(text) AS digest FROM documents"


def _told(spark, path, multi_line):
    back = spark.read.schema("doc_id long, lang string, text string").json(path, multiLine=multi_line)
    return back.select("doc_id", "lang", F.md5("text").alias("digest"))


@register("sink_json", _TOLD)
def sink_json(spark, sf_dir):
    """Arrays of objects, read back as such."""
    path = scratch(spark, "json")
    W.write_json_arrays(docs(spark, sf_dir).select("doc_id", "lang", "text"), path)
    return _told(spark, path, True)


@register("sink_jsonl", _TOLD)
def sink_jsonl(spark, sf_dir):
    path = scratch(spark, "jsonl")
    W.write_json_lines(docs(spark, sf_dir).select("doc_id", "lang", "text"), path)
    return _told(spark, path, False)


@register("sink_tsv_pairs", f"SELECT line FROM (SELECT 'p/' || doc_id || chr(9) || {s_strip('translate(text, chr(9) || chr(10) || chr(13), chr(32) || chr(32) || chr(32))')} AS line FROM documents WHERE {s_strip('text')} <> '')")
def sink_tsv_pairs(spark, sf_dir):
    path = scratch(spark, "pairs")
    line = W.pair_line(F.concat(F.lit("p/"), F.col("doc_id").cast("string")), F.col("text"))
    docs(spark, sf_dir).select(line.alias("value")).where("value IS NOT NULL").write.mode("append").text(path)
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))


@register("skip_if_done", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_if_done(spark, sf_dir):
    return W.pending(docs(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@register("retry_then_log_fail", "SELECT doc_id, CASE WHEN lang = 'de' THEN 'ECHEC' ELSE 'OK' END AS status FROM documents")
def retry_then_log_fail(spark, sf_dir):
    """What fails twice is appended to a log; the log says which documents failed."""

    def work(lang: str) -> str:
        if lang == "de":
            raise ValueError(lang)
        return lang.upper()

    log = scratch(spark, "failures")
    items = docs(spark, sf_dir).select("doc_id", "lang")
    A.append_once(W.attempted(items, work, "lang").where("status <> 'OK'").select("doc_id", "status"), log, "attempts-1")
    failed = A.appended(spark, log, "doc_id long, status string").distinct()
    return items.join(failed, "doc_id", "left").select("doc_id", F.coalesce("status", F.lit("OK")).alias("status"))


@register("cache_by_count", "SELECT (SELECT count(*) FROM documents) AS n, true AS skipped")
def cache_by_count(spark, sf_dir):
    """Build three outputs once, record the manifest, and see that a second build would be skipped."""
    n = docs(spark, sf_dir).count()
    path, outputs = scratch(spark, "manifest"), [scratch(spark, f"built-{k}") for k in range(3)]
    for part, out in zip(("train", "val", "test"), outputs, strict=True):
        D.split(docs(spark, sf_dir).select("doc_id"), "doc_id", 0.1, 0.05).where(F.col("split") == part).write.parquet(out)
    W.append_rows(spark.createDataFrame([(1, n)], "built long, n_inputs long"), path)
    return spark.createDataFrame([(n, W.unchanged(n, spark.read.parquet(path), outputs))], "n long, skipped boolean")


@register("cache_fingerprint", "SELECT sha256('v1' || chr(10) || string_agg(page_id || ':' || sha256(html), chr(10) ORDER BY page_id::VARCHAR)) AS fingerprint FROM pages")
def cache_fingerprint(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("page_id"), "html")
    return W.fingerprint(pages, "page_id", "html")


@register("inputs_digest", "SELECT sha1(string_agg(l, chr(10) ORDER BY l)) AS digest FROM (SELECT url || ':' || page_id || ':' || length(html) AS l FROM pages)")
def inputs_digest(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("url").alias("name"), F.col("page_id").cast("string").alias("stamp"), F.length("html").alias("length"))
    return W.inputs_digest(files)
