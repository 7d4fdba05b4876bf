"""Scores of extraction variants: the flagship and the statistics over score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import scores as S
from ..plans import variants as V
from ..registry import register
from .common import SCORED_VARIANTS, SCORES, docs, q, s_collapse, s_dealt, s_distance, s_fold, s_strip, s_words, scores
from ..functions import text as T

_DAMAGE = """CASE kind WHEN 0 THEN {x} WHEN 1 THEN replace({x}, 'l', '1') WHEN 2 THEN replace({x}, '.', '') WHEN 3 THEN lower({x})
  WHEN 4 THEN substr({x}, 1, CAST(floor(length({x}) * 2 / 3) AS INTEGER)) WHEN 5 THEN replace({x}, 'e', 'c') ELSE replace({x}, ' ', '') END"""
_NORM = lambda x: f"lower({s_strip(s_collapse(x))})"


def _comp(k: str) -> str:
    return f"CASE WHEN r_{k} = 0 OR h_{k} = 0 THEN 0.0 ELSE least(h_{k} / r_{k}::DOUBLE, r_{k} / h_{k}::DOUBLE) END"


def _structure_sql(x: str, p: str) -> str:
    return f"""len(regexp_extract_all({x}, {q(T.WORD)})) AS {p}_words, len(list_filter(string_split({x}, chr(10) || chr(10)), lambda p: NOT regexp_full_match(p, '\\s*'))) AS {p}_paragraphs,
      length({x}) - length(regexp_replace({x}, {q(metrics.UPPER)}, '', 'g')) AS {p}_uppers, length({x}) - length(replace({x}, '.', '')) AS {p}_points, length({x}) - length(replace({x}, '!', '')) AS {p}_exclams"""


_PAIRS = s_dealt(f"SELECT doc_id, idx, {_NORM('ref')} AS r, {_NORM('hyp')} AS h FROM whole")
GRID = f"""refs AS (SELECT doc_id, source, {s_fold('text')} AS ref FROM documents),
 whole AS (SELECT *, {_DAMAGE.format(x='ref')} AS hyp FROM (SELECT *, CAST(i AS INTEGER) AS idx, (doc_id * 31 + i * 17) % 7 AS kind FROM refs, range(4) AS v(i))),
 errors AS (SELECT doc_id, idx, {s_distance('r', 'h')}::DOUBLE / greatest(length(r), 1) AS cer FROM {_PAIRS}),
 tokens AS (SELECT doc_id, idx, token, sum(r) AS r, sum(h) AS h FROM (
   SELECT doc_id, idx, unnest({s_words('ref')}) AS token, 1 AS r, 0 AS h FROM whole UNION ALL SELECT doc_id, idx, unnest({s_words('hyp')}), 0, 1 FROM whole) GROUP BY ALL),
 shared AS (SELECT doc_id, idx, sum(least(r, h))::DOUBLE / sum(greatest(r, h)) AS jacc_multi FROM tokens GROUP BY ALL),
 struct AS (SELECT doc_id, source, idx, {_structure_sql('ref', 'r')}, {_structure_sql('hyp', 'h')} FROM whole),
 cells AS (SELECT doc_id, source, idx, coalesce(cer, 0.0) AS cer, coalesce(jacc_multi, 1.0) AS jacc_multi, ({' + '.join(_comp(k) for k in metrics.STRUCTURE[:5])}) / 5.0 AS ratios_mean
   FROM struct LEFT JOIN errors USING (doc_id, idx) LEFT JOIN shared USING (doc_id, idx))"""


@register("score_grid", f"WITH {GRID} SELECT doc_id, idx, round(cer, 6) AS cer, round(jacc_multi, 6) AS jacc_multi, round(ratios_mean, 6) AS ratios_mean FROM cells")
def score_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = V.scored(docs(spark, sf_dir).select("doc_id", "source", "text"))
    return cells.select("doc_id", "idx", *(F.round(c, 6).alias(c) for c in ("cer", "jacc_multi", "ratios_mean")))


@register("score_winners", f"""WITH {GRID}, best AS (SELECT doc_id, arg_min(idx, row(round(cer, 9), idx)) AS idx FROM cells GROUP BY doc_id),
 won AS (SELECT idx, count(*) AS n_won FROM best GROUP BY idx)
 SELECT c.idx, coalesce(any_value(n_won), 0)::BIGINT AS n_won, round(avg(cer), 6) AS mean_cer, round(avg(jacc_multi), 6) AS mean_jacc, round(avg(ratios_mean), 6) AS mean_ratio FROM cells c LEFT JOIN won USING (idx) GROUP BY c.idx""")
def score_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: variants scored over whole texts, the winner per document counted, means per variant."""
    cells = V.scored(docs(spark, sf_dir).select("doc_id", "source", "text"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.round("cer", 9), "idx")) == 1
    marked = cells.withColumn("won", first.cast("long"))
    return marked.groupBy("idx").agg(F.sum("won").alias("n_won"), F.round(F.avg("cer"), 6).alias("mean_cer"), F.round(F.avg("jacc_multi"), 6).alias("mean_jacc"), F.round(F.avg("ratios_mean"), 6).alias("mean_ratio"))


def score_query(name: str, sql: str):
    return register(name, f"WITH {SCORES} {sql}")


@score_query("agg_mean_by_variant", "SELECT idx, round(avg(cer), 6) AS mean_cer FROM scores GROUP BY idx ORDER BY mean_cer")
def agg_mean_by_variant(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("idx").agg(F.round(F.avg("cer"), 6).alias("mean_cer")).orderBy("mean_cer")


@score_query("agg_profile_by_variant", """, m AS (SELECT *, min(cer) OVER (PARTITION BY idx) AS lo, max(cer) OVER (PARTITION BY idx) AS hi FROM scores)
 SELECT idx, round(avg(cer), 6) AS mean_cer, round(stddev_samp(cer), 6) AS std_cer, round(median(cer), 6) AS median_cer, sum(CASE WHEN cer = lo THEN 1 ELSE 0 END)::BIGINT AS n_min, sum(CASE WHEN cer = hi THEN 1 ELSE 0 END)::BIGINT AS n_max, count(cer) AS n FROM m GROUP BY idx""")
def agg_profile_by_variant(spark, sf_dir):
    p = S.profile_by_variant(scores(spark, sf_dir))
    return p.select("idx", *(F.round(c, 6).alias(c) for c in ("mean_cer", "std_cer", "median_cer")), "n_min", "n_max", "n")


@score_query("agg_min_max_count", "SELECT source, round(avg(cer), 6) AS mean_cer, min(cer) AS min_cer, max(cer) AS max_cer, count(cer) AS n FROM scores GROUP BY source")
def agg_min_max_count(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("source").agg(F.round(F.avg("cer"), 6).alias("mean_cer"), F.min("cer").alias("min_cer"), F.max("cer").alias("max_cer"), F.count("cer").alias("n"))


@score_query("agg_argmin_row", "SELECT doc_id, idx, cer, jacc_multi, ratios_mean FROM scores WHERE cer IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cer, idx) = 1")
def agg_argmin_row(spark, sf_dir):
    row = F.struct("idx", "cer", "jacc_multi", "ratios_mean")
    found = scores(spark, sf_dir).where("cer IS NOT NULL").groupBy("doc_id").agg(F.min_by(row, F.struct("cer", "idx")).alias("r"))
    return found.select("doc_id", "r.*")


@score_query("agg_argmax_row", "SELECT doc_id, idx, jacc_multi FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY jacc_multi DESC, idx) = 1")
def agg_argmax_row(spark, sf_dir):
    found = scores(spark, sf_dir).groupBy("doc_id").agg(F.min_by(F.struct("idx", "jacc_multi"), F.struct(-F.col("jacc_multi"), F.col("idx"))).alias("r"))
    return found.select("doc_id", "r.*")


@score_query("agg_arg_closest_to_one", "SELECT doc_id, idx FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY abs(ratios_mean - 1), idx) = 1")
def agg_arg_closest_to_one(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("doc_id").agg(S.best(F.abs(F.col("ratios_mean") - 1)).alias("idx"))


_WIN = """, w AS (SELECT doc_id, arg_min(idx, row(cer, idx)) FILTER (cer IS NOT NULL) AS by_cer, arg_min(idx, row(-jacc_multi, idx)) AS by_jacc, arg_min(idx, row(abs(ratios_mean - 1), idx)) AS by_ratio FROM scores GROUP BY doc_id)"""


@score_query("agg_value_counts", f"{_WIN} SELECT by_cer AS idx, count(*) AS n FROM w GROUP BY by_cer")
def agg_value_counts(spark, sf_dir):
    return S.winners(scores(spark, sf_dir)).groupBy(F.col("by_cer").alias("idx")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "idx")


@score_query("join_winners", f"{_WIN} SELECT doc_id, by_cer, by_jacc, by_ratio FROM w")
def join_winners(spark, sf_dir):
    return S.winners(scores(spark, sf_dir))


@score_query("prj_concat_profile", f"{_WIN} SELECT concat_ws('|', by_cer, by_jacc, by_ratio) AS profile, count(*) AS n FROM w GROUP BY 1")
def prj_concat_profile(spark, sf_dir):
    names = F.concat_ws("|", *(F.col(c).cast("string") for c in ("by_cer", "by_jacc", "by_ratio")))
    return S.winners(scores(spark, sf_dir)).groupBy(names.alias("profile")).agg(F.count(F.lit(1)).alias("n"))


@score_query("agg_group_members", f"{_WIN} SELECT concat_ws('|', by_cer, by_jacc, by_ratio) AS profile, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS members FROM w GROUP BY 1")
def agg_group_members(spark, sf_dir):
    names = F.concat_ws("|", *(F.col(c).cast("string") for c in ("by_cer", "by_jacc", "by_ratio")))
    grouped = S.winners(scores(spark, sf_dir)).groupBy(names.alias("profile")).agg(F.sort_array(F.collect_list("doc_id")).alias("m"))
    return grouped.select("profile", F.array_join(F.col("m").cast("array<string>"), ",").alias("members"))


@score_query("join_outer_align_counts", f"""{_WIN}, a AS (SELECT by_cer AS idx, count(*) AS n_cer FROM w GROUP BY 1), b AS (SELECT by_jacc AS idx, count(*) AS n_jacc FROM w GROUP BY 1), c AS (SELECT by_ratio AS idx, count(*) AS n_ratio FROM w GROUP BY 1)
 SELECT idx, coalesce(n_cer, 0)::INTEGER AS n_cer, coalesce(n_jacc, 0)::INTEGER AS n_jacc, coalesce(n_ratio, 0)::INTEGER AS n_ratio FROM a FULL JOIN b USING (idx) FULL JOIN c USING (idx)""")
def join_outer_align_counts(spark, sf_dir):
    """Three value counts aligned on their index, missing ones 0; one pass over unpivoted winners instead of two full joins."""
    long = S.winners(scores(spark, sf_dir)).select(F.explode(F.array(*(F.struct(F.col(f"by_{k}").alias("idx"), F.lit(k).alias("k")) for k in ("cer", "jacc", "ratio")))).alias("x")).select("x.*")
    return long.groupBy("idx").agg(*(F.sum((F.col("k") == k).cast("int")).cast("int").alias(f"n_{k}") for k in ("cer", "jacc", "ratio"))).orderBy("idx")


_PIVOT = ", ".join(f"max(CASE WHEN idx = {i} THEN cer END) AS v{i}" for i in range(SCORED_VARIANTS))


@score_query("agg_pivot", f"SELECT doc_id, {_PIVOT} FROM scores GROUP BY doc_id")
def agg_pivot(spark, sf_dir):
    return S.pivot(scores(spark, sf_dir), range(SCORED_VARIANTS), F.first("cer"))


_OK = "(coalesce(cer < 0.08, false) OR jacc_multi > 0.92 OR (ratios_mean > 0.9 AND ratios_mean < 1.1))"


@score_query("agg_pivot_success", f"SELECT doc_id, {', '.join(f'coalesce(avg(CASE WHEN idx = {i} THEN CASE WHEN {_OK} THEN 1.0 ELSE 0.0 END END), 0)::DOUBLE AS v{i}' for i in range(SCORED_VARIANTS))} FROM scores GROUP BY doc_id")
def agg_pivot_success(spark, sf_dir):
    return S.pivot(scores(spark, sf_dir).withColumn("ok", S.success().cast("double")), range(SCORED_VARIANTS), F.avg("ok")).na.fill(0.0)


@score_query("prj_clip", "SELECT doc_id, idx, CASE WHEN cer > 2 THEN 2.0 ELSE cer END AS cer FROM scores")
def prj_clip(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "idx", S.clip().alias("cer"))


@score_query("prj_success", f"SELECT doc_id, idx, {_OK} AS success FROM scores")
def prj_success(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "idx", S.success().alias("success"))


@score_query("prj_fillna", "SELECT doc_id, idx, coalesce(cer, 1.0) AS cer FROM scores")
def prj_fillna(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "idx", "cer").na.fill(1.0, ["cer"])


@score_query("prj_dropna", "SELECT doc_id, idx, cer FROM scores WHERE cer IS NOT NULL")
def prj_dropna(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "idx", "cer").na.drop()


@score_query("prj_rename", "SELECT doc_id AS fichier, idx AS variant, jacc_multi AS jaccard FROM scores")
def prj_rename(spark, sf_dir):
    return scores(spark, sf_dir).select("doc_id", "idx", "jacc_multi").withColumnsRenamed({"doc_id": "fichier", "idx": "variant", "jacc_multi": "jaccard"})


_COVER = f"""WITH RECURSIVE {SCORES}, hits AS MATERIALIZED (SELECT DISTINCT doc_id, idx FROM scores WHERE {_OK}),
 cover(step, idx, gain, taken) AS (
   SELECT 0, -1, 1::BIGINT, []::INTEGER[]
   UNION ALL
   SELECT * FROM (
     SELECT c.step + 1, h.idx, count(*) AS gain, list_append(c.taken, h.idx) FROM cover c, hits h
     WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.doc_id = h.doc_id AND list_contains(c.taken, g.idx))
     GROUP BY c.step, h.idx, c.taken ORDER BY gain DESC, h.idx LIMIT 1))
 SELECT step::INTEGER AS step, idx, gain FROM cover WHERE step > 0"""


@register("win_greedy_cover", _COVER)
def win_greedy_cover(spark, sf_dir):
    return S.greedy_cover(scores(spark, sf_dir))


@register("agg_mean_by_cluster")
def agg_mean_by_cluster(spark, sf_dir):
    """Mean of the three metrics per cluster of documents."""
    from ..operators.clusters import clustered

    rows = clustered(scores(spark, sf_dir).na.fill(1.0, ["cer"]))
    return rows.groupBy("cluster").agg(*(F.round(F.avg(c), 6).alias(f"mean_{c}") for c in ("cer", "jacc_multi", "ratios_mean")))


@register("agg_nested_value_counts")
def agg_nested_value_counts(spark, sf_dir):
    from ..operators.clusters import clustered

    return clustered(scores(spark, sf_dir).na.fill(1.0, ["cer"])).groupBy("idx", "cluster").agg(F.count(F.lit(1)).alias("n"))


@register("win_top1_cluster_sort")
def win_top1_cluster_sort(spark, sf_dir):
    from ..operators.clusters import clustered

    return clustered(scores(spark, sf_dir).na.fill(1.0, ["cer"])).select("cluster", "doc_id", "idx").orderBy("cluster", "doc_id", "idx")


@register("agg_fault_ratio", "SELECT doc_id, (length(text) - length(replace(text, 'e', '')))::BIGINT AS faults, length(text)::BIGINT AS chars, CASE WHEN length(text) = 0 THEN NULL ELSE round((length(text) - length(replace(text, 'e', '')))::DOUBLE / length(text), 6) END AS ratio FROM documents")
def agg_fault_ratio(spark, sf_dir):
    """Faults per character; null for an empty text."""
    rows = docs(spark, sf_dir).select("doc_id", T.count_of("text", "e").cast("long").alias("faults"), F.length("text").cast("long").alias("chars"))
    return rows.withColumn("ratio", F.round(F.try_divide("faults", "chars"), 6))
