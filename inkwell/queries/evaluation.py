"""Error rates and similarities of texts against references, and the streaming extension."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import text as T
from ..operators.similarity import array_distance, matcher_ratio, multiset_overlap, token_distance
from ..plans import variants as V
from ..registry import register
from ..sources.scratch import scratch
from .common import docs, q, s_collapse, s_dealt, s_distance, s_fold, s_strip, s_words, table
from .scores import _DAMAGE, _comp, _structure_sql

_KIND = "(doc_id * 31 + 17) % 7"


def _kind():
    return V.kind_of(F.col("doc_id"), F.lit(1))


_WHOLE = f"(SELECT doc_id, ref, {_DAMAGE.format(x='ref')} AS hyp FROM (SELECT doc_id, {s_fold('text')} AS ref, {_KIND} AS kind FROM documents))"


def _whole(spark, sf_dir):
    """(doc_id, ref, hyp): reference and hypothesis, whole texts."""
    rows = docs(spark, sf_dir).select("doc_id", T.fold_ascii("text").alias("ref"), _kind().alias("kind"))
    return rows.select("doc_id", "ref", V.damage(F.col("ref"), F.col("kind")).alias("hyp"))


def _costly(spark, sf_dir):
    return V.spread(docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", T.fold_ascii("text").alias("ref"), _kind().alias("kind")).select("doc_id", "ref", V.damage(F.col("ref"), F.col("kind")).alias("hyp"))


def _error_rate(spark, sf_dir, norm):
    rows = _costly(spark, sf_dir).select("doc_id", norm(F.col("ref")).alias("r"), norm(F.col("hyp")).alias("h"))
    return rows.select("doc_id", F.round(array_distance(F.col("r"), F.col("h")) / F.greatest(F.length("r"), F.lit(1)), 6).alias("cer"))


def _cer_sql(norm) -> str:
    pairs = s_dealt(f"SELECT doc_id, {norm('ref')} AS r, {norm('hyp')} AS h FROM {_WHOLE}")
    return f"SELECT doc_id, round({s_distance('r', 'h')}::DOUBLE / greatest(length(r), 1), 6) AS cer FROM {pairs}"


_lower = lambda x: f"lower({s_strip(s_collapse(x))})"
register("m_cer_norm", _cer_sql(_lower))(lambda spark, sf_dir: _error_rate(spark, sf_dir, lambda c: F.lower(T.strip(T.collapse(c)))))
register("m_cer_raw", _cer_sql(lambda x: x))(lambda spark, sf_dir: _error_rate(spark, sf_dir, lambda c: c))
register("m_cer_lib", _cer_sql(s_strip))(lambda spark, sf_dir: _error_rate(spark, sf_dir, T.strip))


def _word_error_rate(spark, sf_dir, tokens):
    rows = _costly(spark, sf_dir).select("doc_id", tokens(F.col("ref")).alias("r"), tokens(F.col("hyp")).alias("h"))
    return rows.select("doc_id", F.round(token_distance(F.col("r"), F.col("h")) / F.greatest(F.size("r"), F.lit(1)), 6).alias("wer"))


@register("m_wer_norm")
def m_wer_norm(spark, sf_dir):
    return _word_error_rate(spark, sf_dir, lambda c: T.words_fr(T.norm_metric_composed(c)))


@register("m_wer_lib")
def m_wer_lib(spark, sf_dir):
    return _word_error_rate(spark, sf_dir, T.fields)


_SPACED = lambda x: f"array_to_string(regexp_extract_all({x}, {q(T.NOT_WS + '+')}), ' ')"


_WORDED = s_dealt(f"SELECT doc_id, ref, hyp, {_SPACED('ref')} AS r, {_SPACED('hyp')} AS h, len(regexp_extract_all(ref, {q(T.NOT_WS + '+')})) AS n FROM {_WHOLE}")
_CHARWORD = f"SELECT doc_id, round({s_distance('r', 'h')}::DOUBLE / greatest(n, 1), 6) AS wer FROM {_WORDED}"


@register("m_wer_charword", _CHARWORD)
def m_wer_charword(spark, sf_dir):
    """Distance in characters of the space-normalised texts, per word of the reference."""
    rows = _costly(spark, sf_dir).select("doc_id", F.array_join(T.fields("ref"), " ").alias("r"), F.array_join(T.fields("hyp"), " ").alias("h"), F.size(T.fields("ref")).alias("n"))
    return rows.select("doc_id", F.round(array_distance(F.col("r"), F.col("h")) / F.greatest("n", F.lit(1)), 6).alias("wer"))


@register("m_punct_accuracy")
def m_punct_accuracy(spark, sf_dir):
    """Matcher ratio of the punctuation of both whole texts; 1 if neither has any."""
    only = lambda c: F.regexp_replace(c, r"[^!-/:-@\[-`{-~]", "")
    rows = _costly(spark, sf_dir).select("doc_id", only(F.col("ref")).alias("r"), only(F.col("hyp")).alias("h"))
    return rows.select("doc_id", F.round(matcher_ratio(F.col("r"), F.col("h")), 6).alias("punctuation"))


@register("m_seq_ratio")
def m_seq_ratio(spark, sf_dir):
    """Matcher ratio of both whole texts."""
    return _costly(spark, sf_dir).select("doc_id", F.round(matcher_ratio(F.col("ref"), F.col("hyp")), 6).alias("ratio"))


@register("m_jaccard_set", f"SELECT doc_id, round(CASE WHEN u = 0 THEN 1.0 ELSE i::DOUBLE / u END, 6) AS jaccard FROM (SELECT doc_id, len(list_intersect(a, b)) AS i, len(list_distinct(list_concat(a, b))) AS u FROM (SELECT doc_id, {s_words('ref')} AS a, {s_words('hyp')} AS b FROM {_WHOLE}))")
def m_jaccard_set(spark, sf_dir):
    return _whole(spark, sf_dir).select("doc_id", F.round(M.set_jaccard(T.words("ref"), T.words("hyp")), 6).alias("jaccard"))


_TOK = f"(SELECT doc_id, token, sum(r) AS r, sum(h) AS h FROM (SELECT doc_id, unnest({s_words('ref')}) AS token, 1 AS r, 0 AS h FROM {_WHOLE} UNION ALL SELECT doc_id, unnest({s_words('hyp')}), 0, 1 FROM {_WHOLE}) GROUP BY ALL)"


@register("m_jaccard_multi", f"SELECT doc_id, round(sum(least(r, h))::DOUBLE / sum(greatest(r, h)), 6) AS jaccard FROM {_TOK} GROUP BY doc_id")
def m_jaccard_multi(spark, sf_dir):
    rows = _whole(spark, sf_dir).select("doc_id", T.words("ref").alias("r"), T.words("hyp").alias("h"))
    counted = rows.select("doc_id", multiset_overlap(F.col("r"), F.col("h")).alias("o")).where("o.either > 0")
    return counted.select("doc_id", F.round(F.col("o.both") / F.col("o.either"), 6).alias("jaccard"))


_STRUCT = f"(SELECT doc_id, {_structure_sql('ref', 'r')}, {_structure_sql('hyp', 'h')} FROM {_WHOLE})"


@register("m_ratio_symmetric", f"SELECT doc_id, round({_comp('words')}, 6) AS words, round({_comp('uppers')}, 6) AS uppers, round({_comp('points')}, 6) AS points FROM {_STRUCT}")
def m_ratio_symmetric(spark, sf_dir):
    r, h = M.structure("ref"), M.structure("hyp")
    return _whole(spark, sf_dir).select("doc_id", *(F.round(M.symmetric_ratio(h[k], r[k]), 6).alias(k) for k in ("words", "uppers", "points")))


_MEAN = f"({' + '.join(_comp(k) for k in M.STRUCTURE[:5])}) / 5.0"


@register("m_ratios_mean", f"SELECT doc_id, round({_MEAN}, 6) AS ratios_mean FROM {_STRUCT}")
def m_ratios_mean(spark, sf_dir):
    return _whole(spark, sf_dir).select("doc_id", F.round(M.ratios_mean(M.structure("hyp"), M.structure("ref")), 6).alias("ratios_mean"))


@register("m_round2", f"SELECT doc_id, {_MEAN} AS raw FROM {_STRUCT}")
def m_round2(spark, sf_dir):
    """The unrounded value that a report prints with two decimals."""
    return _whole(spark, sf_dir).select("doc_id", M.ratios_mean(M.structure("hyp"), M.structure("ref")).alias("raw"))


@register("m_score_global", f"SELECT doc_id, round(1 - ({s_distance('ref', 'hyp')}::DOUBLE / greatest(length(ref), 1) + {s_distance('r', 'h')}::DOUBLE / greatest(n, 1)) / 2, 6) AS score FROM {_WORDED}")
def m_score_global(spark, sf_dir):
    """1 - (character rate + word rate) / 2, the word rate in characters per word."""
    rows = _costly(spark, sf_dir).select("doc_id", "ref", "hyp", F.array_join(T.fields("ref"), " ").alias("r"), F.array_join(T.fields("hyp"), " ").alias("h"), F.size(T.fields("ref")).alias("n"))
    cer = array_distance(F.col("ref"), F.col("hyp")) / F.greatest(F.length("ref"), F.lit(1))
    wer = array_distance(F.col("r"), F.col("h")) / F.greatest("n", F.lit(1))
    return rows.select("doc_id", F.round(1 - (cer + wer) / 2, 6).alias("score"))


@register("m_diff_report", f"SELECT doc_id, md5(CASE WHEN r = h THEN '' ELSE '--- Ligne 1 ---' || chr(10) || 'GT : ' || r || chr(10) || 'PR : ' || h || chr(10) END) AS digest FROM (SELECT doc_id, {_lower('ref')} AS r, {_lower('hyp')} AS h FROM {_WHOLE})")
def m_diff_report(spark, sf_dir):
    """Differing lines of both sides, numbered from 1.  The sides are normalised first, which leaves one line."""
    norm = lambda c: F.lower(T.strip(T.collapse(c)))
    rows = _whole(spark, sf_dir).select("doc_id", F.split(norm("ref"), "\n", -1).alias("r"), F.split(norm("hyp"), "\n", -1).alias("h"))
    pairs = F.transform(F.arrays_zip("r", "h"), lambda p, i: F.struct(i.alias("i"), F.coalesce(p["r"], F.lit("")).alias("r"), F.coalesce(p["h"], F.lit("")).alias("h")))
    told = F.transform(F.filter(pairs, lambda p: p["r"] != p["h"]), lambda p: F.concat(F.lit("--- Ligne "), (p["i"] + 1).cast("string"), F.lit(" ---\nGT : "), p["r"], F.lit("\nPR : "), p["h"], F.lit("\n")))
    return rows.select("doc_id", F.md5(F.array_join(told, "\n")).alias("digest"))


@register("agg_macro_mean", "SELECT coalesce(avg(n), 1.0) AS mean_len, count(*) AS n FROM (SELECT length(html)::DOUBLE AS n FROM pages ORDER BY url LIMIT 10)")
def agg_macro_mean(spark, sf_dir):
    """Mean over the first ten pages by name: the limit is the operator's own."""
    first = table(spark, sf_dir, "pages").select("url", F.length("html").cast("double").alias("n")).orderBy("url").limit(10)
    return first.agg(F.coalesce(F.avg("n"), F.lit(1.0)).alias("mean_len"), F.count(F.lit(1)).alias("n"))


# --- streaming extension -------------------------------------------------------------------------------------------
@register("stream_event_windows", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts)::VARCHAR AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_event_windows(spark, sf_dir):
    from ..streaming.windows import tumbling_totals

    return tumbling_totals(spark, sf_dir)


@register("stream_scored_documents", "SELECT doc_id, length(text)::INTEGER AS n FROM documents")
def stream_scored_documents(spark, sf_dir):
    from ..streaming.windows import scored_stream

    return scored_stream(spark, sf_dir)


@register("stream_sessions", """SELECT user_id, min(ts)::VARCHAR AS begun, max(ts)::VARCHAR AS ended, count(*) AS n, round(sum(value), 4) AS total FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session""")
def stream_sessions(spark, sf_dir):
    """Sessions of each user's events by a stream with keyed state, timers and numbered batches; no batch pass."""
    from ..streaming import sessions as S
    from ..streaming.windows import source

    events = source(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"), "value")
    path = scratch(spark, "sessions")
    S.written(S.changes(events), path, f"{path}-log")
    stamp = lambda c: F.regexp_replace(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    at = lambda c: F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(stamp(c))
    return S.table(spark, path).select(F.col("key").alias("user_id"), at("begun").alias("begun"), at("ended").alias("ended"), "n", F.round("total", 4).alias("total"))
