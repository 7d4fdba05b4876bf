"""A lexicon's terms found by one automaton, against a search of every place."""

import random
import time

import pytest
from pyspark.sql import functions as F

from inkwell.operators import lexicon as L


def brute(text, terms):
    """Left to right, at every place the longest term with word edges around it."""
    low, spelling = L.small(text), {}
    for t in terms:
        if t:
            spelling.setdefault(L.small(t), t)
    out, at = [], 0
    word = lambda k: 0 <= k < len(text) and (text[k] == "_" or text[k].isalnum())
    while at < len(text):
        best = max((t for t in spelling if low.startswith(t, at) and not word(at - 1) and not word(at + len(t))), key=len, default=None)
        out.append(spelling[best] if best else text[at])
        at += len(best) if best else 1
    return "".join(out)


def test_terms_equal_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        terms = ["".join(rng.choice("abÉß -'_İ1") for _ in range(rng.randrange(0, 5))) for _ in range(rng.randrange(0, 9))]
        text = "".join(rng.choice("aAbBéÉßẞ -'_İ1.") for _ in range(rng.randrange(40)))
        assert L.Speller(terms).spelt(text) == brute(text, terms)


def test_longest_first_and_whole_words_only():
    spell = L.Speller(["Permis de Construire", "permis", "DE", "Le", "le"]).spelt
    assert spell("PERMIS DE CONSTRUIRE, Permis de, le permise") == "Permis de Construire, permis DE, Le permise"
    assert L.Speller([]).spelt("x") == "x" and L.Speller(["a"]).spelt("") == ""


def test_hundred_thousand_terms_in_one_pass():
    terms = [f"Term{i} of {i % 7}" for i in range(100_000)]
    speller = L.Speller(terms)
    began = time.process_time()
    sizes, times = (2_000, 20_000), []
    for n in sizes:
        text = " ".join(f"TERM{i * 37 % 100_000} OF {i * 37 % 100_000 % 7}, filler" for i in range(n))
        now = time.process_time()
        assert speller.spelt(text) == " ".join(f"Term{i * 37 % 100_000} of {i * 37 % 100_000 % 7}, filler" for i in range(n))
        times.append(time.process_time() - now)
    assert time.process_time() - began < 20 and times[1] < 40 * max(times[0], 0.005)


def test_canonical_case_of_a_table(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the THE of"), (2, None), (3, ""), (4, "other")], "doc_id long, text string")
    table = spark.createDataFrame([("The",), ("THE",), (None,), ("",), ("Of",), ("Of",)], "term string")
    got = {r.doc_id: r.text for r in L.canonical_case(df, table).collect()}
    assert got == {1: "THE THE Of", 2: None, 3: "", 4: "other"}
    assert {r.doc_id: r.text for r in L.canonical_case(df, ["The", "THE"]).collect()}[1] == "The The of"
    assert L.canonical_case(df, table.where("term = ''")).collect() == df.collect()
    assert L.canonical_case(df.limit(0), table).select(F.count("*")).first()[0] == 0
    monkeypatch.setattr(L, "MOST_TERMS", 1)
    with pytest.raises(ValueError):
        L.canonical_case(df, table)
