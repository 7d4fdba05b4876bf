"""Filters, normalisers, segmentation and text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions import text as T
from ..operators import filters as X
from ..operators.dataset import running
from ..operators.similarity import multiset_overlap
from ..operators.unicode import nfkc
from ..plans import postprocess as postprocess_plan
from ..plans.postprocess import postprocess
from ..registry import register
from ..sources.scratch import scratch
from ..sources.sinks import write_json_lines
from .common import docs, q, s_collapse, s_corrections, s_fold, s_lines, s_pairs, s_replace, s_sentences, s_split_after, s_strip, s_words


def _signed(df: DataFrame, c) -> DataFrame:
    """doc_id, MD5 and length of a derived text: small rows to compare whole texts by."""
    return df.select("doc_id", c.alias("x")).select("doc_id", F.md5("x").alias("digest"), F.length("x").cast("long").alias("size"))


def _text_query(name: str, sql: str | None, build) -> None:
    full = None if sql is None else f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS size FROM (SELECT doc_id, {sql} AS x FROM documents)"
    register(name, full)(lambda spark, sf_dir: _signed(docs(spark, sf_dir), build(F.col("text"))))


# --- normalisers ---------------------------------------------------------------------------------------------------
_pairs = lambda *groups: [p for g in groups for p in g]
_METRIC = lambda x: f"lower({s_collapse(s_strip(s_replace(s_pairs(x, _pairs(T.QUOTES, T.DASHES, T.LIGATURES)), '-' + T.WS + '*' + chr(10), '')))})"
_text_query("fn_norm_metric", _METRIC("nfc_normalize(text)"), lambda c: T.norm_metric_composed(nfkc(c)))
_text_query("fn_norm_crop", s_collapse(s_strip(s_pairs("nfc_normalize(text)", _pairs([x for x in T.QUOTES if x[0] != "‘"], T.DASHES, T.LIGATURES)))), lambda c: T.norm_crop_composed(nfkc(c)))
_text_query(
    "fn_norm_label",
    s_replace(s_pairs(f"translate(text, {q(''.join(T.LABEL_ONE))}, {q(''.join(T.LABEL_ONE.values()))})", T.LABEL_MANY.items()), T.LABEL_DROP, ""),
    T.norm_label,
)
# word edges: a guard on both sides instead of look-around; a doubled separator keeps neighbours apart
_WORD_SQL = lambda x, old, new: f"replace(regexp_replace(replace({x}, ' ', '  '), '(^|[^\\p{{L}}\\p{{N}}_])' || {q(old.replace(' ', '  '))} || '([^\\p{{L}}\\p{{N}}_]|\\z)', '\\1' || {q(new.replace(' ', '  '))} || '\\2', 'g'), '  ', ' ')"
_TYPO = lambda x: s_strip(s_collapse(_WORD_SQL(s_collapse(s_pairs(x, _pairs(T.QUOTES, T.GUILLEMETS, [("…", "...")], T.DASHES))), "oe", "œ")))
_text_query("fn_norm_typo", _TYPO("text"), T.norm_typo)
_text_query("fn_norm_quotes", s_strip(s_collapse(s_pairs("text", _pairs(T.QUOTES, T.GUILLEMETS)))), T.norm_quotes)
_text_query("fn_norm_web_line", f"array_to_string(list_transform({s_lines('nfc_normalize(text)')}, lambda l: array_to_string(regexp_extract_all({s_pairs('l', [('’', chr(39)), *T.GUILLEMETS])}, {q(T.NOT_WS + '+')}), ' ')), chr(10))", lambda c: F.array_join(F.transform(T.lines(nfkc(c)), T.norm_web_line), "\n"))
_text_query("fn_norm_url_token", f"replace({s_replace('lower(text)', '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_' + T.WS_SET + ']', ' ')}, '_', ' ')", T.norm_url_token)
_text_query("fn_ascii_slug", s_replace(s_replace(s_fold("text"), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""), lambda c: F.regexp_replace(F.regexp_replace(T.fold_ascii(c), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def _misread_sql(x: str) -> str:
    for old, new in X.MISREAD:
        x = _WORD_SQL(x, old, new)
    return x


_text_query("fn_regex_map", _misread_sql(s_collapse("text")), lambda c: X.correct_misreadings(T.collapse(c)))
_HYPHEN = lambda x: s_replace(s_replace(x, rf"([\p{{L}}\p{{N}}_])-{T.WS}+([\p{{L}}\p{{N}}_])", r"\1\2"), rf"({T.WS}|^)-({T.WS}|\z)", " ")
_text_query("fn_dehyphenate", _HYPHEN("text"), T.dehyphenate)
_text_query(
    "fn_join_paragraph_lines",
    "array_to_string(list_transform(string_split(regexp_replace(regexp_replace(text, '[.]\\n', '.' || chr(10) || chr(10), 'g'), '\\n[ \\t]*(\\n[ \\t]*)+', chr(1), 'g'), chr(1)), lambda b: replace(b, chr(10), ' ') || ' '), chr(10))",
    lambda c: F.array_join(F.transform(F.split(F.regexp_replace(F.regexp_replace(c, r"[.]\n", ".\n\n"), r"\n[ \t]*(\n[ \t]*)+", "\x01"), "\x01", -1), lambda b: F.concat(F.translate(b, "\n", " "), F.lit(" "))), "\n"),
)
_HEADERS = "^(The|Le|Der) "
_text_query("fn_drop_header_lines", f"array_to_string(list_filter({s_lines('text')}, lambda l: NOT regexp_matches(l, {q(_HEADERS)})), chr(10))", lambda c: F.array_join(F.filter(T.lines(c), lambda l: ~l.rlike(_HEADERS)), "\n"))
_SENT1 = lambda x: f"string_split(regexp_replace({x}, {q('([.!?])' + T.WS + '+')}, '\\1' || chr(10), 'g'), chr(10))"
_CAP = lambda s: f"CASE WHEN regexp_matches({s}, '^[a-z]') THEN upper({s}[1]) || {s}[2:] ELSE {s} END"
_text_query("fn_capitalise_after_stop", f"array_to_string(list_transform({_SENT1(s_collapse('text'))}, lambda s, i: CASE WHEN i = 1 THEN s ELSE {_CAP('s')} END), chr(10))", lambda c: F.array_join(F.transform(F.split(F.regexp_replace(T.collapse(c), f"([.!?]){T.WS}+", "$1\n"), "\n", -1), lambda s, i: F.when(i == 0, s).otherwise(X.capital(s))), "\n"))
_text_query("fn_strip_control", s_strip(f"translate(text, chr(9) || chr(13) || chr(10), '   ')"), T.strip_control)
_SPLIT_LONG = lambda x, n: f"array_to_string(list_filter(flatten(list_transform(list_transform({s_lines(x)}, lambda l: {s_strip('l')}), lambda l: CASE WHEN length(l) > {n} THEN {s_split_after('l')} ELSE [l] END)), lambda s: {s_strip('s')} <> ''), chr(10))"
_text_query("fn_split_long_lines", _SPLIT_LONG("text", 1000), lambda c: T.split_long_lines(c, 1000))


@register("fn_lexicon_canonical_case")
def fn_lexicon_canonical_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.lexicon import canonical_case

    return canonical_case(docs(spark, sf_dir).select("doc_id", "text"), ["The", "of", "Permis de Construire", "DER", "le"]).select("doc_id", F.md5("text").alias("digest"))


# --- line and paragraph filters ------------------------------------------------------------------------------------
_NOISE_SQL = "(?i)" + "|".join(p.replace(r"\s", r"[\x09-\x0D\x20]") for p in X.NOISE)
_REASON = lambda l: f"CASE WHEN length({l}) = 0 THEN 'empty' WHEN length({s_replace(l, '[^' + chr(92) + 'p{L}]', '')}) / (length({l}) + 1e-5) < 0.45 AND length({l}) > 16 THEN 'letters' WHEN length({l}) < 4 THEN 'short' WHEN regexp_matches({l}, {q(_NOISE_SQL)}) THEN 'pattern' END"
_TRIMMED = lambda x: f"list_transform({s_lines(x)}, lambda l: {s_strip('l')})"
_PURGE = lambda x: f"array_to_string(list_filter({_TRIMMED(x)}, lambda l: ({_REASON('l')}) IS NULL), chr(10))"
_text_query("flt_noise_lines", _PURGE("text"), X.purge_noise)


@register("sink_rejects", f"SELECT doc_id, reason, count(*) AS n FROM (SELECT doc_id, {_REASON('l')} AS reason FROM (SELECT doc_id, unnest({_TRIMMED('text')}) AS l FROM documents)) WHERE reason IS NOT NULL AND reason <> 'empty' GROUP BY ALL")
def sink_rejects(spark, sf_dir):
    """Dropped lines with their reasons, written beside the noise filter's output as one object a line, and counted from there."""
    dropped = docs(spark, sf_dir).select("doc_id", F.explode(X.noise_lines(F.col("text"))).alias("r")).select("doc_id", "r.reason", "r.line")
    path = scratch(spark, "rejects")
    write_json_lines(dropped, path)
    back = spark.read.schema("doc_id long, reason string, line string").json(path)
    return back.groupBy("doc_id", "reason").agg(F.count(F.lit(1)).alias("n"))


_KEEP_P = lambda p: f"length({p}) >= 5 AND NOT (length({s_replace(p, '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]', '')}) / length({p}) < 0.5 AND length({p}) > 12)"
_DISTINCT = lambda l: f"list_filter({l}, lambda p, i: list_position({l}, p) = i)"
@register("flt_symbol_paragraphs", f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS size FROM (SELECT doc_id, array_to_string({_DISTINCT('f')}, chr(10)) AS x FROM (SELECT doc_id, list_filter({_TRIMMED('text')}, lambda p: {_KEEP_P('p')}) AS f FROM documents))")
def flt_symbol_paragraphs(spark, sf_dir):
    return _signed(docs(spark, sf_dir), F.array_join(X.symbol_paragraphs(T.lines("text")), "\n"))


_text_query("flt_min_line_len", f"array_to_string(list_filter({_TRIMMED('text')}, lambda l: length(l) >= 20), chr(10))", lambda c: F.array_join(F.filter(F.transform(T.lines(c), T.strip), lambda l: F.length(l) >= 20), "\n"))


@register("flt_sentence_len", f"SELECT doc_id, md5(s) AS digest FROM (SELECT doc_id, unnest({s_sentences('text')}) AS s FROM documents) WHERE length(s) > 20 AND length(s) < 300")
def flt_sentence_len(spark, sf_dir):
    each = docs(spark, sf_dir).select("doc_id", F.explode(T.sentences("text")).alias("s"))
    return each.where((F.length("s") > 20) & (F.length("s") < 300)).select("doc_id", F.md5("s").alias("digest"))


@register("flt_too_big_prompt", "SELECT doc_id, n_chars FROM documents WHERE length(text) <= 130000")
def flt_too_big_prompt(spark, sf_dir):
    return docs(spark, sf_dir).where(F.length("text") <= 130_000).select("doc_id", "n_chars")


_KEYWORDS = ["license", "the", "gmail", "der", "password", "la "]


@register("flt_keyword_any", f"SELECT doc_id, array_to_string(hits, ',') AS hits FROM (SELECT doc_id, list_filter({_KEYWORDS!r}, lambda k: contains(lower(text), k)) AS hits FROM documents) WHERE len(hits) > 0")
def flt_keyword_any(spark, sf_dir):
    low = F.lower("text")
    hits = F.filter(F.array(*map(F.lit, _KEYWORDS)), lambda k: F.contains(low, k))
    return docs(spark, sf_dir).select("doc_id", hits.alias("h")).where(F.size("h") > 0).select("doc_id", F.array_join("h", ",").alias("hits"))


_CHARSET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,;:!?'()-éèàç\n"


@register("flt_oov", f"SELECT doc_id, length(translate(text, {q(_CHARSET)}, ''))::BIGINT AS n_oov FROM documents WHERE length(translate(text, {q(_CHARSET)}, '')) > 0")
def flt_oov(spark, sf_dir):
    """Documents with characters outside the charset, and how many."""
    n = F.length(F.translate("text", _CHARSET, "")).cast("long")
    return docs(spark, sf_dir).select("doc_id", n.alias("n_oov")).where("n_oov > 0")


@register("flt_replacement_useful", f"SELECT doc_id, old, new FROM (SELECT doc_id, p[1] AS old, p[2] AS new FROM (SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) AS p FROM (SELECT doc_id, {s_words('text')} AS w FROM documents))) WHERE old <> '' AND new <> '' AND old <> new AND NOT regexp_matches(old, {q(X.TRIVIAL)}) AND NOT regexp_matches(new, {q(X.TRIVIAL)})")
def flt_replacement_useful(spark, sf_dir):
    """Every pair of neighbouring words of the whole text as a replacement."""
    words = docs(spark, sf_dir).select("doc_id", T.words("text").alias("w"))
    pairs = words.select("doc_id", F.explode(F.expr("transform(slice(w, 2, greatest(size(w) - 1, 0)), (x, i) -> struct(w[i] AS old, x AS new))")).alias("p")).select("doc_id", "p.old", "p.new")
    return pairs.where(X.useful_replacement(F.col("old"), F.col("new")))


# --- segmentation and extraction -----------------------------------------------------------------------------------
@register("fn_sentences_regex", f"SELECT doc_id, len(s)::INTEGER AS n, md5(array_to_string(s, chr(1))) AS digest FROM (SELECT doc_id, {s_sentences('text')} AS s FROM documents)")
def fn_sentences_regex(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.sentences("text").alias("s")).select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "\x01")).alias("digest"))


@register("fn_sentences_model")
def fn_sentences_model(spark, sf_dir):
    """The pluggable sentence model: any DataFrame function (text array column added); by default the rule-based one."""
    from ..operators.providers import split_sentences

    return split_sentences(docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.size("sentences").alias("n"))


_PERSON = r"(?:Monsieur|Madame|M\.|Mme|The|Le|Der) +[A-ZÉÈÀ][a-z]+"


# the tables' prose holds no titles, so each text gets some
_NAMED = "(SELECT doc_id, text || ' Madame ' || CASE doc_id % 3 WHEN 0 THEN 'Alder' WHEN 1 THEN 'Breton' ELSE 'cern' END || ', The  Court, M. Durand, The ' || CASE doc_id % 2 WHEN 0 THEN 'Court' ELSE 'bench' END || ' Le Roy' AS text FROM documents)"


def _named(spark, sf_dir):
    d = F.col("doc_id")
    name = F.when(d % 3 == 0, "Alder").when(d % 3 == 1, "Breton").otherwise("cern")
    return docs(spark, sf_dir).select("doc_id", F.concat("text", F.lit(" Madame "), name, F.lit(", The  Court, M. Durand, The "), F.when(d % 2 == 0, "Court").otherwise("bench"), F.lit(" Le Roy")).alias("text"))


@register("fn_person_entities", f"SELECT doc_id, array_to_string(list_sort(list_distinct(p)), ',') AS people FROM (SELECT doc_id, regexp_extract_all(text, {q(_PERSON)}) AS p FROM {_NAMED}) WHERE len(p) > 0")
def fn_person_entities(spark, sf_dir):
    """Set of titles followed by a capitalised word: the default of the pluggable entity model."""
    found = _named(spark, sf_dir).select("doc_id", F.regexp_extract_all("text", F.lit(_PERSON), F.lit(0)).alias("p")).where(F.size("p") > 0)
    return found.select("doc_id", F.array_join(F.sort_array(F.array_distinct("p")), ",").alias("people"))


@register("fn_tokens_word", f"SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, ' ')) AS digest FROM (SELECT doc_id, {s_words('text')} AS w FROM documents)")
def fn_tokens_word(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.words("text").alias("w")).select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("digest"))


@register("fn_tokens_fr", f"SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, ' ')) AS digest FROM (SELECT doc_id, regexp_extract_all(text, {q(T.WORD_FR)}) AS w FROM documents)")
def fn_tokens_fr(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.words_fr("text").alias("w")).select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("digest"))


_PERMIT = r"(?i)Permis de construire n[°º]?[\x09-\x0D\x20]*([0-9A-Z]+)"
# the tables hold no permit numbers or French dates: each document gets a line of them made of its id
_NOTE_SQL = "text || chr(10) || 'Permis de Construire n° ' || doc_id || 'AB, le ' || (doc_id % 28 + 1) || ' ' || ['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre'][doc_id % 12 + 1] || ' ' || (1990 + doc_id % 30)"
MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]


def _noted(spark, sf_dir):
    d = F.col("doc_id")
    month = F.element_at(F.array(*map(F.lit, MONTHS)), (d % 12 + 1).cast("int"))
    note = F.concat(F.lit("\nPermis de Construire n° "), d.cast("string"), F.lit("AB, le "), (d % 28 + 1).cast("string"), F.lit(" "), month, F.lit(" "), (1990 + d % 30).cast("string"))
    return docs(spark, sf_dir).select("doc_id", F.concat("text", note).alias("text"))


@register("fn_extract_permit_no", f"SELECT doc_id, regexp_extract({_NOTE_SQL}, {q(_PERMIT)}, 1) AS permit FROM documents")
def fn_extract_permit_no(spark, sf_dir):
    return _noted(spark, sf_dir).select("doc_id", F.regexp_extract("text", _PERMIT, 1).alias("permit"))


_DATE = r"(?i)(\d{1,2})[\x09-\x0D\x20]+(janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre)[\x09-\x0D\x20]+(\d{4})"


@register("fn_extract_date_fr", f"SELECT doc_id, CASE WHEN d = '' THEN '' ELSE make_date(y::BIGINT, list_position({MONTHS!r}, lower(m))::BIGINT, d::BIGINT)::VARCHAR END AS iso FROM (SELECT doc_id, regexp_extract(t, {q(_DATE)}, 1) AS d, regexp_extract(t, {q(_DATE)}, 2) AS m, regexp_extract(t, {q(_DATE)}, 3) AS y FROM (SELECT doc_id, {_NOTE_SQL} AS t FROM documents))")
def fn_extract_date_fr(spark, sf_dir):
    part = lambda k: F.regexp_extract("text", _DATE.replace("(?i)", "(?iu)"), k)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(part(2))).cast("int")
    date = F.make_date(part(3).try_cast("int"), month, part(1).try_cast("int"))
    return _noted(spark, sf_dir).select("doc_id", F.coalesce(date.cast("string"), F.lit("")).alias("iso"))


@register("fn_lexical_cues", f"SELECT doc_id, len(list_filter({s_sentences('text')}, lambda s: regexp_matches(lower(s), '(^|[^\\p{{L}}\\p{{N}}_])(for the|loué|commerce|der|dans)([^\\p{{L}}\\p{{N}}_]|\\z)')))::INTEGER AS n FROM documents")
def fn_lexical_cues(spark, sf_dir):
    """Sentences in which any cue pattern occurs."""
    cue = r"(^|[^\p{L}\p{N}_])(for the|loué|commerce|der|dans)([^\p{L}\p{N}_]|\z)"
    return docs(spark, sf_dir).select("doc_id", F.size(F.filter(T.sentences("text"), lambda s: F.lower(s).rlike(cue))).alias("n"))


@register("fn_sections")
def fn_sections(spark, sf_dir):
    """Titled sections of structured judgments."""
    from ..operators.sections import structured

    titles = ["Faits", "Procédure", "Dispositif"]
    first = F.regexp_replace("text", r"\n", "\n\n")
    parts = F.concat(*(x for t in titles for x in (F.lit(f"{t} \n"), first, F.lit(f"\n{t.lower()}\n"))))
    return structured(docs(spark, sf_dir).select("doc_id", parts.alias("text"))).select("doc_id", F.map_keys("sections").alias("k"), F.md5(F.to_json("sections")).alias("digest")).select("doc_id", F.array_join("k", ",").alias("titles"), "digest")


@register("fn_json_config_digest", "SELECT doc_id, md5(text) AS digest, '{\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}' AS config FROM documents")
def fn_json_config_digest(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5("text").alias("digest"), F.to_json(F.struct("lang", "source")).alias("config"))


@register("fn_parse_metric_log", "SELECT doc_id, regexp_extract(l, 'acc: *([0-9.]+)', 1)::DOUBLE AS acc, regexp_extract(l, 'norm_edit_dis: *([0-9.]+)', 1)::DOUBLE AS norm_edit_dis FROM (SELECT doc_id, 'step ' || doc_id || ' acc: 0.' || (doc_id % 89 + 10) || ', norm_edit_dis:0.' || (doc_id % 71 + 10) AS l FROM documents)")
def fn_parse_metric_log(spark, sf_dir):
    d = F.col("doc_id")
    line = F.concat(F.lit("step "), d.cast("string"), F.lit(" acc: 0."), (d % 89 + 10).cast("string"), F.lit(", norm_edit_dis:0."), (d % 71 + 10).cast("string"))
    number = lambda name: F.regexp_extract("l", rf"{name}: *([0-9.]+)", 1).try_cast("double").alias(name)
    return docs(spark, sf_dir).select("doc_id", line.alias("l")).select("doc_id", number("acc"), number("norm_edit_dis"))


@register("fn_prompt_build", "SELECT doc_id, md5('Classify each sentence of the text.' || chr(10) || text) AS digest FROM documents")
def fn_prompt_build(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(F.concat(F.lit("Classify each sentence of the text.\n"), "text")).alias("digest"))


# --- aggregates over tokens and characters -------------------------------------------------------------------------
_TOKENS = f"(SELECT doc_id, unnest({s_words('text')}) AS token FROM documents)"


def _tokens(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.explode(T.words("text")).alias("token"))


@register("agg_token_counts", f"SELECT doc_id, count(*) AS n_types, max(n) AS most FROM (SELECT doc_id, token, count(*) AS n FROM {_TOKENS} GROUP BY ALL) GROUP BY doc_id")
def agg_token_counts(spark, sf_dir):
    counts = _tokens(spark, sf_dir).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_types"), F.max("n").alias("most"))


@register("agg_rare_words", f"SELECT doc_id, md5(string_agg(token, ' ' ORDER BY token)) AS digest, count(*) AS n FROM (SELECT doc_id, token FROM {_TOKENS} GROUP BY ALL HAVING count(*) < 2) WHERE token NOT IN {tuple(X.STOPWORDS)!r} GROUP BY doc_id")
def agg_rare_words(spark, sf_dir):
    rare = _tokens(spark, sf_dir).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")).where("n < 2").where(~F.col("token").isin(X.STOPWORDS))
    grouped = rare.groupBy("doc_id").agg(F.sort_array(F.collect_list("token")).alias("w"))
    return grouped.select("doc_id", F.md5(F.array_join("w", " ")).alias("digest"), F.size("w").cast("long").alias("n"))


@register("agg_char_dictionary", "SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE NOT regexp_full_match(c, '\\s*') GROUP BY c")
def agg_char_dictionary(spark, sf_dir):
    """Characters that are no space, by frequency: counted within each text first, so a task emits a row per character and text at most."""
    each = docs(spark, sf_dir).select(F.explode(F.split("text", "")).alias("c")).where(~F.col("c").rlike(r"^\s*\z"))
    return each.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c")


_CAPS = r"[A-Z][a-z]{3,}(?: [A-Z][a-z]+)*"


@register("agg_caps_terms", f"SELECT DISTINCT term FROM (SELECT term FROM (SELECT unnest(regexp_extract_all(text, {q(_CAPS)})) AS term FROM documents) GROUP BY term HAVING count(*) > 1 AND length(term) > 3 UNION ALL SELECT text FROM benchmark) ORDER BY term")
def agg_caps_terms(spark, sf_dir):
    """Capitalised phrases that occur more than once, merged into a lexicon, sorted and distinct."""
    from .common import table

    found = docs(spark, sf_dir).select(F.explode(F.regexp_extract_all("text", F.lit(_CAPS), F.lit(0))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND length(term) > 3")
    return found.select("term").union(table(spark, sf_dir, "benchmark").select("text")).distinct().orderBy("term")


@register("agg_text_stats", f"SELECT doc_id, length(text)::BIGINT AS chars, len(regexp_extract_all(text, {q(T.WORD)}))::BIGINT AS words, len({s_lines('text')})::BIGINT AS lines, CASE WHEN length(text) = 0 THEN 0 ELSE round(length({s_replace('text', '[^' + chr(92) + 'p{L}]', '')})::DOUBLE / length(text), 6) END AS alpha FROM documents")
def agg_text_stats(spark, sf_dir):
    alpha = F.when(F.length("text") == 0, F.lit(0.0)).otherwise(F.round(T.letters("text") / F.length("text"), 6))
    return docs(spark, sf_dir).select("doc_id", F.length("text").cast("long").alias("chars"), F.regexp_count("text", F.lit(T.WORD)).cast("long").alias("words"), F.size(T.lines("text")).cast("long").alias("lines"), alpha.alias("alpha"))


# --- sets and sorts ------------------------------------------------------------------------------------------------
@register("set_dedup_paragraphs", f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS size FROM (SELECT doc_id, array_to_string({_DISTINCT('f')}, chr(10)) AS x FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: {s_strip('l')}), lambda l: l <> '') AS f FROM documents))")
def set_dedup_paragraphs(spark, sf_dir):
    return _signed(docs(spark, sf_dir), T.dedup_lines("text"))


_HALVES = f"(SELECT doc_id, {s_words('text')} AS a, {s_words('replace(text, chr(101), chr(97))')} AS b FROM documents)"


def _halves(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.words("text").alias("a"), T.words(F.translate("text", "e", "a")).alias("b"))


@register("set_intersect_union", f"SELECT doc_id, round(CASE WHEN u = 0 THEN 1.0 ELSE i::DOUBLE / u END, 6) AS jaccard FROM (SELECT doc_id, len(list_intersect(a, b)) AS i, len(list_distinct(list_concat(a, b))) AS u FROM {_HALVES})")
def set_intersect_union(spark, sf_dir):
    return _halves(spark, sf_dir).select("doc_id", F.round(metrics.set_jaccard("a", "b"), 6).alias("jaccard"))


_MULTI = f"(SELECT doc_id, token, sum(x) AS x, sum(y) AS y FROM (SELECT doc_id, unnest(a) AS token, 1 AS x, 0 AS y FROM {_HALVES} UNION ALL SELECT doc_id, unnest(b), 0, 1 FROM {_HALVES}) GROUP BY ALL)"


def _multi(spark, sf_dir):
    counted = _halves(spark, sf_dir).select("doc_id", multiset_overlap(F.col("a"), F.col("b")).alias("o"))
    return counted.select("doc_id", "o.both", "o.either").where("either > 0")


@register("set_multiset_and_or", f"SELECT doc_id, sum(least(x, y))::BIGINT AS both, sum(greatest(x, y))::BIGINT AS either FROM {_MULTI} GROUP BY doc_id")
def set_multiset_and_or(spark, sf_dir):
    return _multi(spark, sf_dir)


@register("join_multiset", f"SELECT doc_id, round(sum(least(x, y))::DOUBLE / sum(greatest(x, y)), 6) AS jaccard FROM {_MULTI} GROUP BY doc_id")
def join_multiset(spark, sf_dir):
    """Multiset Jaccard of the two sides of a row."""
    return _multi(spark, sf_dir).select("doc_id", F.round(F.col("both") / F.col("either"), 6).alias("jaccard"))


@register("set_difference", f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(a, lambda w: NOT list_contains(b, w)))), ' ') AS only FROM (SELECT doc_id, regexp_extract_all(text, {q(_PERSON)}) AS a, regexp_extract_all(text, 'The +[A-Z][a-z]+') AS b FROM {_NAMED})")
def set_difference(spark, sf_dir):
    """Entities that are new: those of one set without those of another."""
    every, known = (F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in (_PERSON, "The +[A-Z][a-z]+"))
    return _named(spark, sf_dir).select("doc_id", F.array_join(F.sort_array(F.array_except(every, known)), " ").alias("only"))


@register("set_union_all", "SELECT doc_id AS id, md5(text) AS digest FROM documents UNION ALL SELECT item_id, md5(text) FROM benchmark")
def set_union_all(spark, sf_dir):
    from .common import table

    a = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), F.md5("text").alias("digest"))
    return a.unionByName(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.md5("text").alias("digest")))


@register("set_distinct_sorted", f"SELECT DISTINCT token FROM {_TOKENS} ORDER BY token")
def set_distinct_sorted(spark, sf_dir):
    return _tokens(spark, sf_dir).select("token").distinct().orderBy("token")


@register("set_near_dup_sentences")
def set_near_dup_sentences(spark, sf_dir):
    """Sentences of each document without near duplicates (greedy, by token overlap)."""
    from ..operators.consensus import without_near_duplicates

    return without_near_duplicates(docs(spark, sf_dir).select("doc_id", T.sentences("text").alias("sentences"))).select("doc_id", F.size("sentences").alias("n"), F.md5(F.array_join("sentences", "\n")).alias("digest"))


# --- pipelines -----------------------------------------------------------------------------------------------------
def _clean_sql(x: str) -> str:
    joined = f"array_to_string(list_filter(list_transform(string_split({_HYPHEN(x)}, chr(10)), lambda l: {s_strip('l')}), lambda l: l <> ''), ' ')"
    return f"list_filter(list_transform(list_transform({_SENT1(joined)}, lambda s, i: CASE WHEN i = 1 THEN s ELSE {_CAP('s')} END), lambda p: {s_strip('p')}), lambda p: {_KEEP_P('p')})"


@register("clean_ocr_text", f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS size FROM (SELECT doc_id, array_to_string({_DISTINCT('f')}, chr(10)) AS x FROM (SELECT doc_id, {_clean_sql('text')} AS f FROM documents))")
def clean_ocr_text(spark, sf_dir):
    return _signed(docs(spark, sf_dir), X.clean_paragraphs(F.col("text")))


@register(
    "postprocess_pipeline",
    f"""SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS size FROM (SELECT doc_id, array_to_string({_DISTINCT('f')}, chr(10)) AS x FROM (SELECT doc_id, list_filter(list_transform({_DISTINCT('g')}, lambda l: {s_strip('l')}), lambda l: l <> '') AS f FROM (
      SELECT doc_id, {_clean_sql('p')} AS g FROM (SELECT doc_id, {_PURGE('s')} AS p FROM (SELECT doc_id, {_SPLIT_LONG('m', 1000)} AS s FROM (SELECT doc_id, {_misread_sql('t')} AS m FROM (SELECT doc_id, {_TYPO('text')} AS t FROM documents)))))))""",
)
def postprocess_pipeline(spark, sf_dir):
    out = postprocess(docs(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("size"))


@register(
    "postprocess_full",
    f"""WITH {s_corrections(f"SELECT doc_id, array_to_string({_DISTINCT('g')}, chr(10)) AS text FROM (SELECT doc_id, {_clean_sql('p')} AS g FROM (SELECT doc_id, {_PURGE('s')} AS p FROM (SELECT doc_id, {_SPLIT_LONG('m', 1000)} AS s FROM (SELECT doc_id, {_misread_sql('t')} AS m FROM (SELECT doc_id, {_TYPO('text')} AS t FROM documents)))))")},
 whole AS (SELECT texts.doc_id, coalesce(string_agg(coalesce(fixed, piece), '' ORDER BY i), '') AS y, count(fixed) AS n FROM texts LEFT JOIN spelt ON texts.doc_id = spelt.doc_id GROUP BY texts.doc_id),
 cut AS (SELECT doc_id, n, list_filter(list_transform(string_split(y, chr(10)), lambda l: {s_strip('l')}), lambda l: l <> '') AS f FROM whole)
 SELECT doc_id, md5(array_to_string({_DISTINCT('f')}, chr(10))) AS digest FROM cut""",
)
def postprocess_full(spark, sf_dir):
    """All eight steps: the six of postprocess_pipeline with rare words found and corrected before repeated lines go."""
    out, _ = postprocess_plan.postprocess_full(docs(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.md5("text").alias("digest"))


@register("label_blank", f"SELECT doc_id, md5(unnest({s_sentences('text')})) AS phrase, '' AS label FROM documents")
def label_blank(spark, sf_dir):
    """Every sentence with an empty label, to be filled by hand."""
    return docs(spark, sf_dir).select("doc_id", F.explode(T.sentences("text")).alias("s")).select("doc_id", F.md5("s").alias("phrase"), F.lit("").alias("label"))


@register("m_text_structure", f"SELECT doc_id, len(regexp_extract_all(text, {q(T.WORD)}))::BIGINT AS words, len(list_filter(string_split(text, chr(10) || chr(10)), lambda p: NOT regexp_full_match(p, '\\s*')))::BIGINT AS paragraphs, (length(text) - length(regexp_replace(text, {q(metrics.UPPER)}, '', 'g')))::BIGINT AS uppers, (length(text) - length(replace(text, '.', '')))::BIGINT AS points, (length(text) - length(replace(text, '!', '')))::BIGINT AS exclams, (length(text) - length(replace(text, '?', '')))::BIGINT AS quests FROM documents")
def m_text_structure(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", *(c.alias(k) for k, c in metrics.structure("text").items()))


@register("srt_most_common", f"SELECT token, n FROM (SELECT token, count(*) AS n FROM {_TOKENS} GROUP BY token) WHERE n > 50")
def srt_most_common(spark, sf_dir):
    """Tokens that occur more than 50 times, most frequent first; ties in order of the token."""
    return _tokens(spark, sf_dir).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 50").orderBy(F.desc("n"), "token")


@register("srt_natural", "SELECT doc_id, dense_rank() OVER (ORDER BY regexp_extract(source, '^[^0-9]+'), regexp_extract(source, '[0-9]+')::INTEGER)::INTEGER AS place FROM documents")
def srt_natural(spark, sf_dir):
    """Names in natural order: digits compare as numbers, the rest without case; the distinct names are ranked, not the rows."""
    name = F.lower("source")
    key = F.array_join(F.transform(F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0)), lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x)), "\x00")
    rows = docs(spark, sf_dir).select("doc_id", key.alias("k"))
    places = running(rows.select("k").distinct(), "k", F.lit(1))
    return rows.join(places, "k").select("doc_id", (F.col("before") + 1).cast("int").alias("place"))
