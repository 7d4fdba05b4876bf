"""Training sets: gates, tiers, splits, samples, joins by name, crops."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dataset as D
from ..plans import variants as V
from ..registry import register
from .common import docs, q, s_pairs, s_replace, s_strip, table

# training lines of whole texts: a label per 78 characters, or 100 in documents that pass the limit; some without path, some
# with characters outside the set, and an empty one at the end of some
_WIDTH = "CASE WHEN doc_id % 7 = 1 THEN 100 ELSE 78 END"
_ROWS = f"""(SELECT doc_id, k, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 'crops/' || doc_id || '.png' END AS path, CASE doc_id % 7 WHEN 1 THEN piece WHEN 2 THEN CASE WHEN k % 4 = 0 THEN '√' ELSE '' END || piece ELSE piece || CASE WHEN (doc_id + k) % 9 = 0 THEN '…' ELSE '' END END AS label
  FROM (SELECT doc_id, k, text[1 + k * {_WIDTH}:(k + 1) * {_WIDTH}] AS piece FROM (SELECT doc_id, text, unnest(range(0, (length(text) + {_WIDTH} - 1) // ({_WIDTH}) + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END)) AS k FROM documents)))"""


def _rows(spark, sf_dir):
    """Labels made for crops of all lines of a text, as long as a crop can hold or a little longer."""
    d, k = F.col("doc_id"), F.col("k")
    cut = lambda width: F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    pieces = F.concat(F.when(d % 7 == 1, cut(100)).otherwise(cut(78)), F.when(d % 7 == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    each = docs(spark, sf_dir).select("doc_id", F.posexplode(pieces).alias("k", "piece"))
    piece = F.col("piece")
    more = F.when((d + k) % 9 == 0, "…").otherwise("")
    sign = F.when(k % 4 == 0, "√").otherwise("")
    label = F.when(d % 7 == 1, piece).when(d % 7 == 2, F.concat(sign, piece)).otherwise(F.concat(piece, more))
    return each.select("doc_id", k.cast("long").alias("k"), F.when(d % 11 != 0, F.concat(F.lit("crops/"), d.cast("string"), F.lit(".png"))).alias("path"), label.alias("label"))


_SET = D.CHARSET + "\n"
_NORMED = s_replace(s_pairs(f"translate(label, {q(''.join(T.LABEL_ONE))}, {q(''.join(T.LABEL_ONE.values()))})", T.LABEL_MANY.items()), T.LABEL_DROP, "")
_GATE = f"""SELECT path, CASE WHEN path IS NULL OR label IS NULL THEN 'malformed' WHEN label = '' THEN 'empty' WHEN length(label) > 78 THEN 'too_long' WHEN length(translate({_NORMED}, {q(_SET)}, '')) > 0 THEN 'out_of_charset'
  WHEN path NOT IN (SELECT 'crops/' || doc_id || '.png' FROM labels) THEN 'missing' ELSE 'kept' END AS status, md5({_NORMED}) AS digest FROM {_ROWS}"""


def _gated(spark, sf_dir):
    images = table(spark, sf_dir, "labels").select(F.concat(F.lit("crops/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("path"))
    return D.gate(_rows(spark, sf_dir).select("path", "label"), D.ctc_limit(320, 4), charset=_SET, images=images)


@register("flt_label_validate", _GATE)
def flt_label_validate(spark, sf_dir):
    return _gated(spark, sf_dir).select("path", "status", F.md5("label").alias("digest"))


@register("agg_counters", f"SELECT status, count(*) AS n FROM ({_GATE}) GROUP BY status")
def agg_counters(spark, sf_dir):
    return _gated(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("flt_ctc_limit", f"SELECT doc_id, k, length(label)::INTEGER AS n FROM {_ROWS} WHERE length(label) <= 78")
def flt_ctc_limit(spark, sf_dir):
    return _rows(spark, sf_dir).where(F.length("label") <= D.ctc_limit(320, 4)).select("doc_id", "k", F.length("label").alias("n"))


# metrics of crops by arithmetic on line items
_METRICS = """(SELECT l_orderkey, l_linenumber, 10 + (l_orderkey % 40)::INTEGER AS h, (l_partkey % 230) / 10.0::DOUBLE AS ratio, (l_suppkey % 12) / 100.0::DOUBLE AS edge_ink, l_quantity * 4 AS lap_var, l_quantity AS std,
  (l_partkey % 100) / 100.0::DOUBLE AS black, CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS oov, (l_partkey % 90)::INTEGER AS len, CASE WHEN l_orderkey % 40 < 8 THEN 1 ELSE 0 END AS too_small_h, CASE WHEN l_partkey % 230 > 150 THEN 1 ELSE 0 END AS crazy_ratio FROM lineitem)"""


def _metrics(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.lit(10) + c("l_orderkey") % 40).cast("int").alias("h"), ((c("l_partkey") % 230) / 10.0).alias("ratio"), ((c("l_suppkey") % 12) / 100.0).alias("edge_ink"), (c("l_quantity") * 4).alias("lap_var"), c("l_quantity").alias("std"),
        ((c("l_partkey") % 100) / 100.0).alias("black"), (c("l_orderkey") % 17 == 0).cast("int").alias("oov"), (c("l_partkey") % 90).cast("int").alias("len"), (c("l_orderkey") % 40 < 8).cast("int").alias("too_small_h"), (c("l_partkey") % 230 > 150).cast("int").alias("crazy_ratio"),
    )


@register("cls_quality_tiers", f"""SELECT tier, count(*) AS n, sum(len)::BIGINT AS chars FROM (SELECT len, CASE WHEN h >= 22 AND ratio <= 10 AND edge_ink <= 0.02 AND lap_var >= 60 AND std >= 25 AND black BETWEEN 0.15 AND 0.85 AND oov = 0 AND len BETWEEN 3 AND 80 AND too_small_h = 0 AND crazy_ratio = 0 THEN 'A'
  WHEN too_small_h = 1 OR crazy_ratio = 1 OR edge_ink > 0.08 OR oov > 0 OR h < 16 OR ratio > 20 OR lap_var < 20 OR std < 10 OR black < 0.05 OR black > 0.95 THEN 'C' ELSE 'B' END AS tier FROM {_METRICS}) GROUP BY tier""")
def cls_quality_tiers(spark, sf_dir):
    return _metrics(spark, sf_dir).groupBy(D.tier().alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("chars"))


# --- joins ---------------------------------------------------------------------------------------------------------
@register("join_cross_grid", "SELECT doc_id, CAST(i AS INTEGER) AS idx, 'recipe-' || lpad(i::VARCHAR, 2, '0') AS params FROM documents, range(16) AS v(i)")
def join_cross_grid(spark, sf_dir):
    """Every document with every one of 16 recipes."""
    return V.grid(docs(spark, sf_dir).select("doc_id"), 16)


@register("join_stem_inner", "SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)")
def join_stem_inner(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@register("join_stem_missing", "SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)")
def join_stem_missing(spark, sf_dir):
    """The warning list beside join_stem_inner: what has no partner."""
    return docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


_IMAGES = "(SELECT DISTINCT CASE doc_id % 4 WHEN 0 THEN 'img' || doc_id WHEN 1 THEN 'img' || doc_id || '_0001' WHEN 2 THEN md5(doc_id::VARCHAR) ELSE 'none' || doc_id END AS stem FROM documents)"
_INDEX = "(SELECT 'j/' || doc_id || '.json' AS json, CASE WHEN doc_id % 3 = 0 THEN 'img' || doc_id END AS json_stem, 'img' || (doc_id - doc_id % 2) AS original_stem, md5(doc_id::VARCHAR) AS page_hash FROM documents)"


@register("join_priority_lookup", f"""WITH i AS {_IMAGES}, x AS {_INDEX}, k AS (SELECT 0 AS kind, json_stem AS key, max(json) AS json FROM x WHERE json_stem IS NOT NULL GROUP BY ALL UNION ALL SELECT 1, original_stem, max(json) FROM x GROUP BY ALL UNION ALL SELECT 2, page_hash, max(json) FROM x GROUP BY ALL),
 t AS (SELECT stem, 0 AS s, stem AS key FROM i UNION ALL SELECT stem, 1, regexp_replace(stem, '^(.+)_[0-9][0-9][0-9][0-9]$', '\\1') FROM i)
 SELECT i.stem, arg_min(json, s * 3 + kind) AS json FROM i LEFT JOIN (SELECT t.stem, t.s, k.kind, k.json FROM t JOIN k USING (key)) h USING (stem) GROUP BY i.stem""")
def join_priority_lookup(spark, sf_dir):
    d = F.col("doc_id")
    s = d.cast("string")
    stems = docs(spark, sf_dir).select(F.when(d % 4 == 0, F.concat(F.lit("img"), s)).when(d % 4 == 1, F.concat(F.lit("img"), s, F.lit("_0001"))).when(d % 4 == 2, F.md5(s)).otherwise(F.concat(F.lit("none"), s)).alias("stem")).distinct()
    index = docs(spark, sf_dir).select(F.concat(F.lit("j/"), s, F.lit(".json")).alias("json"), F.when(d % 3 == 0, F.concat(F.lit("img"), s)).alias("json_stem"), F.concat(F.lit("img"), (d - d % 2).cast("string")).alias("original_stem"), F.md5(s).alias("page_hash"))
    return D.priority_lookup(stems, index)


@register("fn_stem_normalise", "SELECT doc_id, regexp_replace('s' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_0042' ELSE '_42' END, '^(.+)_[0-9][0-9][0-9][0-9]$', '\\1') AS stem FROM documents")
def fn_stem_normalise(spark, sf_dir):
    d = F.col("doc_id")
    return docs(spark, sf_dir).select("doc_id", D.stem_normalised(F.concat(F.lit("s"), d.cast("string"), F.when(d % 2 == 0, "_0042").otherwise("_42"))).alias("stem"))


@register("join_anti_existing", "SELECT url, query FROM (SELECT 'u' || (doc_id % 700) AS url, min(doc_id) AS query FROM documents GROUP BY 1) WHERE url NOT IN (SELECT 'u' || (item_id * 3) FROM benchmark)")
def join_anti_existing(spark, sf_dir):
    """New links of a run, the first query that found each, without those known."""
    found = docs(spark, sf_dir).select(F.concat(F.lit("u"), (F.col("doc_id") % 700).cast("string")).alias("url"), "doc_id")
    known = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("u"), (F.col("item_id") * 3).cast("string")).alias("url"))
    return found.groupBy("url").agg(F.min("doc_id").alias("query")).join(known, "url", "left_anti")


@register("join_anti_failed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def join_anti_failed(spark, sf_dir):
    """Items without a failure in the progress log, whatever the case and blanks of its status."""
    log = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, " echec ").otherwise("OK").alias("status"))
    failed = log.where(F.upper(T.strip("status")) == "ECHEC")
    return docs(spark, sf_dir).select("doc_id").join(failed, "doc_id", "left_anti")


@register("join_semi_file_exists", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def join_semi_file_exists(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")


@register("juri_pairs", "SELECT 'crops/' || doc_id || '/lang.png' AS path, lang AS label FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) UNION ALL SELECT 'crops/' || doc_id || '/source.png', source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def juri_pairs(spark, sf_dir):
    """Label maps to pairs, those whose image exists."""
    from ..sources.readers import label_rows

    raw = docs(spark, sf_dir).select("doc_id", F.to_json(F.struct(F.struct("lang", "source").alias("labels"))).alias("value"))
    pairs = label_rows(raw).join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return pairs.select(F.concat(F.lit("crops/"), F.col("doc_id").cast("string"), F.lit("/"), "key", F.lit(".png")).alias("path"), T.strip_control("label").alias("label"))


# --- order, samples, splits ----------------------------------------------------------------------------------------
_HASH = "sha256(doc_id || '|42')"


@register("spl_train_val_test", f"SELECT doc_id, CASE WHEN p <= greatest(1, round_even(n * 0.1, 0)) THEN 'val' WHEN p <= greatest(1, round_even(n * 0.1, 0)) + greatest(1, round_even(n * 0.05, 0)) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY {_HASH}, doc_id) AS p, count(*) OVER () AS n FROM documents)")
def spl_train_val_test(spark, sf_dir):
    return D.split(docs(spark, sf_dir).select("doc_id"), "doc_id", 0.1, 0.05)


@register("smp_80_pct", f"SELECT id FROM (SELECT doc_id AS id, row_number() OVER (ORDER BY {_HASH}, doc_id) AS p, count(*) OVER () AS n FROM documents) WHERE p <= floor(n * 0.8) UNION ALL SELECT item_id FROM benchmark")
def smp_80_pct(spark, sf_dir):
    """80 % of the documents, without replacement, and the synthetic rows."""
    rows = docs(spark, sf_dir).select("doc_id")
    most = int(rows.count() * 0.8)
    part = D.ranked(rows, "doc_id", 42).where(F.col("place") <= most).select(F.col("doc_id").alias("id"))
    return part.unionByName(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id")))


@register("lim_random_100", f"SELECT doc_id FROM documents ORDER BY {_HASH}, doc_id LIMIT 100")
def lim_random_100(spark, sf_dir):
    """A reproducible random sample of 100: the operator is a sample by nature."""
    return docs(spark, sf_dir).orderBy(D.hash_order("doc_id", 42), "doc_id").limit(100).select("doc_id")


@register("lim_target_600k", "SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 600000")
def lim_target_600k(spark, sf_dir):
    """Documents in order until their characters reach 600,000."""
    return D.until_target(docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", "n_chars", 600_000)


@register("lim_first_10_pages", "SELECT url FROM pages ORDER BY url LIMIT 10")
def lim_first_10_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("url").orderBy("url").limit(10)


@register("top_match_half", "SELECT vec_id FROM (SELECT vec_id, row_number() OVER (ORDER BY d, vec_id) AS p, count(*) OVER () AS n FROM (SELECT vec_id, round(embedding[1]::DOUBLE * 1000)::BIGINT AS d FROM embeddings)) WHERE p <= n // 2")
def top_match_half(spark, sf_dir):
    """The nearer half of all matches, by distance and id; the first component stands for the distance."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.get("embedding", 0).cast("double") * 1000).cast("long").alias("d"))
    return D.nearest(rows, "d", "vec_id", rows.count() // 2).select("vec_id")


@register("win_chunk_groups", """WITH r AS (SELECT source, doc_id, lang || doc_id AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS p FROM documents),
 b AS (SELECT *, p // 14 AS blk, p % 14 AS pos, ('0x' || md5(source || '|' || (p // 14) || '|0')[1:6])::INTEGER % 4 AS turn FROM r),
 g AS (SELECT *, CASE turn WHEN 0 THEN (pos >= 2)::INTEGER + (pos >= 5)::INTEGER + (pos >= 9)::INTEGER WHEN 1 THEN (pos >= 3)::INTEGER + (pos >= 7)::INTEGER + (pos >= 12)::INTEGER WHEN 2 THEN (pos >= 4)::INTEGER + (pos >= 9)::INTEGER + (pos >= 11)::INTEGER ELSE (pos >= 5)::INTEGER + (pos >= 7)::INTEGER + (pos >= 10)::INTEGER END AS run FROM b)
 SELECT source, text FROM (SELECT source, string_agg(t, ' ' ORDER BY p) AS text FROM g GROUP BY source, blk, run) WHERE length(text) BETWEEN 10 AND 100""")
def win_chunk_groups(spark, sf_dir):
    rows = docs(spark, sf_dir).select("source", "doc_id", F.concat("lang", F.col("doc_id").cast("string")).alias("text"))
    return D.chunked(rows, "source", "doc_id", "text")
