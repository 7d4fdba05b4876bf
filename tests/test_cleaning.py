"""The pipeline's steps on batches, against the column builders, and where they are run."""

import random
import re

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import cleaning as C
from inkwell.operators import filters as X
from inkwell.operators import spelling as S
from inkwell.plans.postprocess import postprocess

PARTS = [
    *T.WS_CHARS, *"aéZıİſKœßΣς²½५一_-.?!,:@#*=%$\\\x01\U0001f600́", "\r\n", " - ", "-\n", "oe", " oe ", "12 %", "7%", "====", "--", "’", "“", "«", "…", "–", ". ", "! ", "mot", "abcdefghij ", "# * | ",
    "Mentions Légales", "\nDocument :", "\nrésumé poétique", "@StuDocu", "@ſtudocu", "\nquestıons-cours", "\nPLUS DE :", *(old for old, _ in X.MISREAD), " a'est ", " aride\n",
]


def odd_texts(n):
    rng = random.Random(11)
    return [None, "", " ", "\n", "\n\n", *("".join(rng.choice(PARTS) * rng.choice([1, 1, 1, 3]) for _ in range(rng.randrange(1, 90))) for _ in range(n))]


def test_steps_equal_the_column_builders(spark):
    """Before, each step searched every character of a text by Java's classes, several times; there were no steps on batches."""
    custom = [("m(o)t", "$1x")]
    both = [
        (T.norm_typo, C.typography), (X.correct_misreadings, C.misreadings), (lambda c: X.correct_misreadings(c, custom), lambda c: C.misreadings(c, custom)),
        (lambda c: T.split_long_lines(c, 40), lambda c: C.split_long(c, 40)), (X.purge_noise, C.purge), (X.clean_paragraphs, C.clean), (T.dedup_lines, C.dedup),
    ]
    df = spark.createDataFrame([(t,) for t in odd_texts(600)], "t string").repartition(4)
    for builder, step in both:
        rows = df.select("t", builder(F.col("t")).alias("want"), step(F.col("t")).alias("got")).collect()
        assert [r for r in rows if r.want != r.got] == []


def test_texts_are_spread(spark, tmp_path):
    """Before, a file of one row group was one task's work: all of the pipeline on one core."""
    df = spark.createDataFrame([(k, "The winter is near.") for k in range(8)], "id int, text string").coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and postprocess(df).rdd.getNumPartitions() == cores
    assert postprocess(df.repartition(cores + 1)).rdd.getNumPartitions() == cores + 1
    assert sorted(r.id for r in postprocess(df).collect()) == list(range(8))
    df.write.parquet(f"{tmp_path}/one")
    plan = postprocess(spark.read.parquet(f"{tmp_path}/one"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RoundRobinPartitioning") == 1
    df.repartition(cores).write.parquet(f"{tmp_path}/many")
    assert len(spark.read.parquet(f"{tmp_path}/many").inputFiles()) < cores or "RoundRobin" not in postprocess(spark.read.parquet(f"{tmp_path}/many"))._jdf.queryExecution().executedPlan().toString()


def test_each_step_is_run_once(spark):
    out = postprocess(spark.createDataFrame([("a",)], "text string")).select(F.md5("text"), F.length("text"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[", plan)) == 1 and plan.count("regexp") == 0


def test_words_and_places_of_odd_texts():
    """Before, words were matched three times a text by Java's classes and sorted."""
    word = re.compile(r"\w+")
    for t in filter(None, odd_texts(600)):
        own, low = list(word.finditer(t)), word.findall(t.lower())
        assert S._words(t.lower()) == low
        tokens = list(zip(low, own, strict=True)) if len(low) == len(own) else [(w, m) for m in own for w in word.findall(m[0].lower())]
        here = [w for w, _ in tokens]
        for most in (1, 2):
            want = [(w, m.start() if m[0].lower() == w else None) for w, m in tokens if low.count(w) <= most and here.count(w) and S.LEAST <= len(w) <= S.LONGEST and w not in S.STOPWORDS and w != "abcdefghij"]
            assert S._rare_places(t, most, frozenset(["abcdefghij"])) == want


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "COUNTED", 2)
    df = spark.createDataFrame([("A b, c. D_e a",), (None,), ("",), ("b İ a",)] * 30, "text string").repartition(3)
    assert {r.word: r.n for r in S.word_counts(df).collect()} == {"a": 90, "b": 60, "c": 30, "d_e": 30, "i": 30}
