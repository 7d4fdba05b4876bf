"""Spans found by the index of shared runs against a search of every span of every document."""

import random

import numpy as np
from pyspark.sql import functions as F

from inkwell.operators import consensus as C
from inkwell.operators import matching as M

WORDS = "the cat sat on a mat dog ran far away over été it's winter rivers mountain quickly yellow evening paper".split()


def sentence(rng, n=(3, 12)):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(*n))).capitalize() + rng.choice(".?!")


def damaged(rng, text, share):
    return "".join(rng.choice("xyz") if rng.random() < share else c for c in text)


def test_winnowing_keeps_a_gram_of_every_shared_run():
    rng = random.Random(1)
    for _ in range(300):
        run = "".join(rng.choice("abcdé ") for _ in range(M.SEED))
        ours = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(60))) + run + "".join(rng.choice("abcdé ") for _ in range(rng.randrange(60)))
        kept = M.gram_hashes(ours)
        chosen = set(kept[M.winnowed(kept)].tolist())
        assert chosen & set(M.gram_hashes(run).tolist())
        assert len(chosen) < len(kept) or len(kept) < 3
    assert len(M.winnowed(M.gram_hashes("short"))) == 0 and len(M.winnowed(M.gram_hashes("a" * M.GRAM))) == 1
    values = np.array([3, 1, 2, 5, 4], np.uint64)
    assert M._sliding(np.minimum, values, 3).tolist() == [1, 1, 2] and M._sliding(np.maximum, values, 5).tolist() == [5]


def share_a_run(a, b):
    a, b = C.clean(a.lower()), C.clean(b.lower())
    runs = {a[i : i + M.SEED] for i in range(len(a) - M.SEED + 1)}
    return any(b[i : i + M.SEED] in runs for i in range(len(b) - M.SEED + 1))


def best_of_all(target, documents, include_last):
    """(score, first span of it) over all spans of all documents, and the first sentence that the target holds."""
    spans = [(-score, doc, i, j, " ".join(s[i:j])) for doc, s in documents for u in [s[: len(s) - (not include_last)]] for i in range(len(u)) for j in range(i + 1, min(i + 4, len(u)) + 1) for score in [C.ratio(C.clean(target.lower()), C.clean(" ".join(u[i:j]).lower()))] if score >= 0.7]
    part = next((x for _, s in documents for x in s if C.clean(x.lower()) in C.clean(target.lower())), None)
    return min(spans, default=None), part


def test_matches_equal_a_search_of_every_span(spark):
    rng = random.Random(4)
    documents = [(k, [sentence(rng) for _ in range(rng.randrange(1, 9))]) for k in range(40)]
    documents += [(100 + k, documents[k % 5][1]) for k in range(30)]  # copies
    targets = ["", "x", " \t", "Été.", "no such passage at all anywhere, of any length"]
    for _ in range(25):
        _, s = rng.choice(documents)
        i = rng.randrange(len(s))
        targets.append(damaged(rng, " ".join(s[i : i + rng.randrange(1, 5)]), rng.choice([0, 0.02, 0.05])))
    rows = spark.createDataFrame([*documents, (7, None), (8, []), (None, ["Nothing like it."])], "doc long, sentences array<string>").repartition(4)
    asked = [(t, t) for t in targets] + [("null", None), (targets[6], targets[6])]
    passages = spark.createDataFrame(asked, "target string, phrase string")
    for include_last in (False, True):
        got = {r.target: r for r in M.best_matches(rows, passages, include_last=include_last).collect()}
        assert "null" not in got
        seen = 0
        for t in targets:
            best, part = best_of_all(t, documents, include_last)
            span, score, found = (got[t].span, got[t].score, got[t].part) if t in got else (None, None, None)
            assert found == part
            if best and share_a_run(t, best[4]):
                assert (span, score) == (best[4], -best[0])
                seen += 1
            else:
                assert span is None or score <= -best[0]
        assert seen >= 12


def test_matches_that_share_no_run_are_found(spark):
    rng = random.Random(8)
    documents = [(k, [sentence(rng, (2, rng.choice([6, 14, 24]))) for _ in range(rng.randrange(2, 8))]) for k in range(30)]
    targets = ["", "q"]
    for share in (0.1, 0.15, 0.2, 0.22) * 8:
        _, s = rng.choice(documents)
        i = rng.randrange(len(s))
        targets.append(damaged(rng, " ".join(s[i : i + rng.randrange(1, 5)]), share))
    rows = spark.createDataFrame(documents, "doc long, sentences array<string>").repartition(3)
    passages = spark.createDataFrame([(t, t) for t in dict.fromkeys(targets)], "target string, phrase string")
    got = {r.target: r for r in M.best_matches(rows, passages).collect()}
    unseeded = 0
    for t in targets:
        best, _ = best_of_all(t, documents, False)
        assert (best and (best[4], -best[0])) == ((got[t].span, got[t].score) if t in got and got[t].span is not None else None)
        unseeded += bool(best) and not share_a_run(t, best[4])
    assert unseeded >= 5


def test_bounds_leave_no_span_out():
    rng = random.Random(6)
    letters = "aaaaaabbbcde fgh漢😀"
    for least in (0.5, 0.7, 1.0):
        for _ in range(6):
            lists = [[rng.choice(["", " ", "a" * 300, "".join(rng.choice(letters) for _ in range(rng.choice([3, 40, 150, 260])))]) for _ in range(rng.randrange(1, 6))] for _ in range(3)]
            docs = [rng.choice([1, 2]) for _ in lists]
            phrases = ["", "a" * 280, "\udc80"] + [damaged(rng, " ".join(s[k : k + 2]), rng.choice([0, 0.1, 0.2])) for s in lists for k in range(len(s))]
            found = M.better_spans(docs, lists, phrases, [None] * len(phrases), least=least)
            for t, p in enumerate(phrases):
                every = [(-C.ratio(C.clean(p.lower()), C.clean(x.lower())), d, i, j, x) for d, s in zip(docs, lists, strict=True) for i in range(len(s)) for j in range(i + 1, min(i + 4, len(s)) + 1) for x in [" ".join(s[i:j])]]
                assert found.get(t) == min((x for x in every if -x[0] >= least), default=None)


def test_many_rows_of_one_id_and_one_text(spark):
    text = ["A sentence that is long enough to be found.", "And another one of its kind.", "The end."]
    rows = spark.createDataFrame([(None, text)] * 400 + [(3, text)] * 400 + [(2, ["Short.", "End."])], "doc long, sentences array<string>").repartition(6)
    passages = spark.createDataFrame([("p", " ".join(text[:2]).upper()), ("q", "so short. it is")], "target string, phrase string")
    got = {r.target: (r.span, r.score, r.part) for r in M.best_matches(rows, passages).collect()}
    assert got == {"p": (" ".join(text[:2]), 1.0, text[0]), "q": (None, None, "Short.")}
    assert M.best_matches(rows.limit(0), passages).count() == 0 and M.best_matches(rows, passages.limit(0)).count() == 0


def test_ranges_around_places():
    assert M._around([5, 6, 20], 30, 4) == [(2, 10), (17, 24)]
    assert M._around([0], 1, 4) == [(0, 1)] and M._around([], 3, 4) == []
    assert M._around([2, 9], 10, 4) == [(0, 10)]


def test_best_span_has_the_first_of_equals():
    assert C.best_span("a b", ["A b", "a  b", "x"]) == ("A b", 1.0)
    assert C.best_range("a b", ["zzz"]) is None and C.best_range("", []) is None


def test_label_match_query_columns(spark):
    from inkwell.queries.sequences import label_match

    out = label_match(spark, "/root/testdata/sf0.001")
    assert out.columns == ["item_id", "label", "source", "digest"]
    assert out.select(F.count("*")).first()[0] == spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").count()
