"""What queries and their oracles share: tables, and SQL fragments for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import spelling
from ..operators.filters import STOPWORDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def q(s: str) -> str:
    """A string as an SQL literal."""
    return "'" + s.replace("'", "''") + "'"


def s_replace(x: str, pattern: str, new: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(new)}, 'g')"


def s_strip(x: str) -> str:
    return s_replace(x, T.STRIP.replace(r"\x{85}", "\x85"), "")


def s_collapse(x: str) -> str:
    return s_replace(x, f"{T.WS}+", " ")


def s_pairs(x: str, pairs) -> str:
    for old, new in pairs:
        x = f"replace({x}, {q(old)}, {q(new)})"
    return x


def s_fold(x: str) -> str:
    opened = s_pairs(f"translate({x}, {q(T.ACCENTED)}, {q(T.PLAIN)})", [("œ", "oe"), ("Œ", "Oe"), ("æ", "ae"), ("Æ", "Ae"), ("ß", "ss")])
    return s_replace(opened, r"[^\x00-\x7F]", "")


def s_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(T.WORD)})"


def s_split_after(x: str) -> str:
    return f"string_split(regexp_replace({x}, {q(T.SENTENCE_END)}, '\\1' || chr(1), 'g'), chr(1))"


def s_distance(a: str, b: str) -> str:
    """Edit distance of ASCII texts; equal ones and beginnings need no matrix."""
    return f"(CASE WHEN {a} = {b} THEN 0 WHEN starts_with({a}, {b}) THEN length({a}) - length({b}) ELSE levenshtein({a}, {b}) END)"


def s_dealt(rows: str) -> str:
    """Rows of unique doc_id (and idx), dealt to all threads: a scan of few row groups would measure them on one."""
    return f"(SELECT DISTINCT * FROM ({rows}))"


def s_lines(x: str) -> str:
    whole = f"string_split_regex({x}, {q(T.LINE_END)})"
    return f"(CASE WHEN {whole}[-1] = '' THEN {whole}[:-2] ELSE {whole} END)"


def s_sentences(x: str) -> str:
    no_cr = s_replace(f"replace({x}, chr(13), '')", r"\n{3,}", "\n\n")
    joined = s_replace(f"replace({no_cr}, chr(10) || chr(10), chr(2))", r"\n", " ")
    parts = f"flatten(list_transform(string_split({joined}, chr(2)), lambda b: {s_split_after(s_strip('b'))}))"
    return f"list_filter(list_transform({parts}, lambda s: {s_strip('s')}), lambda s: s <> '')"


#: accented letters, each as a sign that no word holds, for an engine that measures words by their bytes
_ACCENTED = "àâäáãåçéèêëîïíìôöóòõùûüúÿñßœæ"
_SIGNS = '!"#$%&()*+,-./:;<=>?@[]^`{|}~'


def s_corrections(texts: str) -> str:
    """CTEs over texts (doc_id, text): ``nearest`` (word, fixed, edits) by all pairs of rare and known words, ``spelt`` (doc_id, i, piece, fixed) of all pieces."""
    plain = lambda x: f"translate({x}, '{_ACCENTED}', '{_SIGNS[: len(_ACCENTED)]}')"
    within = f"length(word) BETWEEN {spelling.LEAST} AND {spelling.LONGEST}"
    stop = ", ".join(map(q, STOPWORDS))
    return f"""texts AS MATERIALIZED ({texts}),
 tokens AS (SELECT doc_id, word, count(*) AS here FROM (SELECT doc_id, unnest({s_words('text')}) AS word FROM texts) GROUP BY ALL),
 counts AS MATERIALIZED (SELECT word, sum(here) AS n FROM tokens GROUP BY word),
 rare AS MATERIALIZED (SELECT doc_id, word FROM tokens JOIN counts USING (word) WHERE here = 1 AND n < {spelling.KNOWN} AND {within} AND word NOT IN ({stop})),
 asked AS MATERIALIZED (SELECT DISTINCT word, {plain('word')} AS a FROM rare),
 known AS MATERIALIZED (SELECT word AS fixed, n, {plain('word')} AS b FROM counts WHERE n >= {spelling.KNOWN} AND {within}),
 near AS (SELECT word, fixed, n, damerau_levenshtein(a, b)::INTEGER AS edits FROM asked JOIN known ON abs(length(a) - length(b)) <= 2 WHERE edits <= CASE WHEN length(word) < {spelling.TWO_EDITS} THEN 1 ELSE 2 END),
 nearest AS MATERIALIZED (SELECT word, arg_min(fixed, {{'e': edits, 'n': -n, 'w': fixed}}) AS fixed, min(edits) AS edits FROM near GROUP BY word),
 pieces AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, {q(T.WORD + '|[^' + T.WORD[1:-2] + ']+')}) AS p FROM texts)),
 spelt AS (SELECT pieces.doc_id, i, piece, nearest.fixed FROM pieces LEFT JOIN rare ON pieces.doc_id = rare.doc_id AND lower(piece) = rare.word LEFT JOIN nearest ON rare.word = nearest.word)"""


#: a score table with ties, nulls, values above the clip and documents that nothing covers
SCORES = """scores AS (
  SELECT doc_id, source, CAST(i AS INTEGER) AS idx,
         CASE WHEN (doc_id * 7 + i * 3) % 29 = 0 THEN NULL ELSE ((doc_id * 37 + i * 11) % 230) / 100.0::DOUBLE END AS cer,
         ((doc_id * 13 + i * 29) % 101) / 100.0::DOUBLE AS jacc_multi,
         0.5::DOUBLE + ((doc_id * 17 + i * 5) % 100) / 100.0::DOUBLE AS ratios_mean
  FROM documents, range(8) AS v(i))"""
SCORED_VARIANTS = 8


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table SCORES."""
    i = F.col("idx")
    rows = docs(spark, sf_dir).select("doc_id", "source").crossJoin(F.broadcast(spark.range(SCORED_VARIANTS).select(F.col("id").cast("int").alias("idx"))))
    hundredth = lambda c: c / F.lit(100.0)
    d = F.col("doc_id")
    return rows.select(
        "doc_id", "source", "idx",
        F.when((d * 7 + i * 3) % 29 != 0, hundredth((d * 37 + i * 11) % 230)).alias("cer"),
        hundredth((d * 13 + i * 29) % 101).alias("jacc_multi"),
        (F.lit(0.5) + hundredth((d * 17 + i * 5) % 100)).alias("ratios_mean"),
    )
