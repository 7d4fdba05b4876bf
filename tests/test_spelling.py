"""Rare words corrected by frequent ones, against edits tried one by one and all pairs."""

import collections
import random
import re

import pytest

from inkwell.functions import text as T
from inkwell.operators import spelling as S


def one_edit(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}


def test_distance_is_the_least_number_of_edits():
    rng = random.Random(1)
    for _ in range(60):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 6)))
        one = one_edit(a, "abc")
        two = {w for x in one for w in one_edit(x, "abc")}
        for b in rng.sample(sorted(two), min(30, len(two))):
            assert S.distance(a, b, 2) == (0 if a == b else 1 if b in one else 2)
        for _ in range(30):
            b = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 8)))
            assert (S.distance(a, b, 2) <= 2) == (b == a or b in one or b in two)


def test_near_distances_of_many_pairs():
    """Before, each pair that met was measured by itself, a cell at a time."""
    rng = random.Random(2)
    some = lambda: "".join(rng.choice("abcd𝄞") for _ in range(rng.randrange(0, 9)))
    pairs = [("ca", "abc"), ("abc", "ca"), ("xabcy", "xcay"), ("", ""), ("", "ab"), ("abc", "")]
    for _ in range(4000):
        a = b = some()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b) + 1)
            b = rng.choice([b[:at] + b[at + 1 :], b[:at] + "x" + b[at:], b[:at] + b[at : at + 2][::-1] + b[at + 2 :], b[:at] + "z" + b[at + 1 :]])
        pairs += [(a, b), (a, some())]
    found = S.near_distances(*map(list, zip(*pairs, strict=True)))
    assert found.tolist() == [S.distance(a, b, 2) for a, b in pairs]


def test_words_one_edit_away_need_no_two_deletions(spark, monkeypatch):
    asked = []
    whole = S._nearest
    monkeypatch.setattr(S, "_nearest", lambda rare, known, most: asked.append((most, sorted(r.word for r in rare.collect()))) or whole(rare, known, most))
    rare = spark.createDataFrame([("mountxin",), ("moxxtain",), ("rivxr",), ("rxvxr",), ("quietness",)], "word string")
    known = spark.createDataFrame([("mountain", 30), ("river", 25), ("mountainous", 20)], "word string, n long")
    assert {tuple(r) for r in S.corrections(rare, known).collect()} == {("mountxin", "mountain", 1), ("moxxtain", "mountain", 2), ("rivxr", "river", 1)}
    assert asked == [(1, ["mountxin", "moxxtain", "quietness", "rivxr", "rxvxr"]), (2, ["moxxtain", "quietness"])]


def nearest(word, known):
    most = 1 if len(word) < S.TWO_EDITS else 2
    found = [(d, -n, v) for v, n in known.items() if v != word for d in [S.distance(word, v, most)] if d <= most]
    return min(found, default=None)


def test_corrections_equal_all_pairs(spark):
    rng = random.Random(3)
    known = {"".join(rng.choice("abcdé") for _ in range(rng.randrange(S.LEAST, 11))): rng.randrange(20, 24) for _ in range(150)}
    rare = {"".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 12))) for _ in range(300)} | {"x" * 40}
    for w in list(known)[:80]:
        at = rng.randrange(len(w))
        rare |= {w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + w[at : at + 2][::-1] + w[at + 2 :], "z" + w + "z"}
    rare -= set(known)
    got = {r.word: (r.edits, r.correction) for r in S.corrections(spark.createDataFrame([(w,) for w in rare] * 2 + [(None,)], "word string"), spark.createDataFrame(list(known.items()), "word string, n long")).collect()}
    want = {w: (b[0], b[2]) for w in rare if S.LEAST <= len(w) <= S.LONGEST for b in [nearest(w, known)] if b}
    assert got == want and len(want) > 100


def test_rare_words(spark):
    df = spark.createDataFrame([("b q b c Le le zz c c zz dans a",), ("",), (None,), ("one",)], "text string")
    assert [r[0] for r in df.select(S.rare_words(T.words("text"))).collect()] == [["q"], [], None, ["one"]]
    assert [r[0] for r in df.select(S.rare_words(T.words("text"), 2)).collect()] == [["b", "q", "zz"], [], None, ["one"]]


@pytest.mark.parametrize("known", [3, 20])
def test_corrected_texts_equal_brute_force(spark, known):
    rng = random.Random(8)
    words = ["winter", "rivers", "mountain", "quickly", "yellow", "evening", "paper", "le", "été", "ab"]
    texts = []
    for _ in range(60):
        line = [rng.choice(words) for _ in range(rng.randrange(1, 15))]
        for k in range(len(line)):
            if rng.random() < 0.15:
                at = rng.randrange(len(line[k]))
                line[k] = line[k][:at] + rng.choice("xyz") + line[k][at + 1 :]
        texts.append(", ".join(line).capitalize() + ".\n\n" + line[0].upper())
    rows = [(k % 7 or None, t, "e") for k, t in enumerate(texts)] + [(1, None, "e"), (2, "", "e"), (3, " \n", "e"), (4, texts[0], "e"), (4, "Wintxr " * 500 + "rivxrs", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(3)
    out, found = S.corrected(df, known=known)
    word = re.compile(r"\w+")
    counts = collections.Counter(w for _, t, _ in rows for w in word.findall((t or "").lower()))
    frequent = {w: n for w, n in counts.items() if n >= known and S.LEAST <= len(w) <= S.LONGEST}
    fixes = {}

    def fixed(text):
        here = collections.Counter(word.findall(text.lower()))

        def new(m):
            w = m[0].lower()
            best = nearest(w, frequent) if here[w] == 1 and counts[w] < known and S.LEAST <= len(w) <= S.LONGEST and w not in S.STOPWORDS else None
            if best:
                fixes[w] = best[2]
            return best[2] if best else m[0]

        return word.sub(new, text)

    want = collections.Counter((d, None if t is None else fixed(t), e) for d, t, e in rows)
    assert collections.Counter(map(tuple, out.collect())) == want
    assert {r.word: r.correction for r in found.collect()} == fixes
    logged = spark.createDataFrame(list(fixes.items())[:2], "old string, new string")
    assert {(r.old, r.new) for r in S.useful(found, logged).collect()} == set(list(fixes.items())[2:])
    assert S.corrected(df.limit(0))[0].count() == 0


@pytest.mark.parametrize("bits", [64, 1 << 27])
def test_a_full_sieve_loses_nothing(spark, monkeypatch, bits):
    """Before, remains were sent to Spark whole, and shuffled whole where the known ones were too many to be sent to all tasks."""
    monkeypatch.setattr(S, "SIEVE", bits)
    rng = random.Random(5)
    known = {"".join(rng.choice("abcde") for _ in range(rng.randrange(S.LEAST, 10))): n for n in range(20, 220)}
    rare = {"".join(rng.choice("abcde") for _ in range(rng.randrange(S.LEAST, 10))) for _ in range(200)} - set(known)
    got = {r.word: r.correction for r in S.corrections(spark.createDataFrame([(w,) for w in rare], "word string"), spark.createDataFrame(list(known.items()), "word string, n long")).collect()}
    assert got == {w: b[2] for w in rare for b in [nearest(w, known)] if b}
    hashes = spark.createDataFrame([(h,) for row in S._remains(list(known), 2) for h in row.tolist()], "rest long")
    sieve = S._sieve(hashes, bits)
    assert len(sieve) == bits // 8 and [r.tolist() for r in S._remains(list(known), 2, sieve)] == [r.tolist() for r in S._remains(list(known), 2)]
    assert bits == 64 or sum(map(len, S._remains(list(rare), 2, sieve))) < sum(map(len, S._remains(list(rare), 2))) / 2


def test_pairs_are_measured_once(spark):
    """Before, the filter by distance measured every pair a second time."""
    rare, known = spark.createDataFrame([("mountxin",)], "word string"), spark.createDataFrame([("mountain", 30)], "correction string, n long")
    plan = S._nearest(rare, known, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?:apart|measured)\(", plan)) == 1


@pytest.mark.parametrize("most", [1, 2])
def test_replaced_by_place(spark, most):
    words = "winter mountain evening " * 20
    texts = ["(Wintxr, mountaix!", "Évening\n evenxng  Wintxr", "İwintxr İ mountxin İ", "\U0001f600wintxr", "wintxr mountain", "wintxr, Wintxr", "evͅenxng evenxng", "ΟΔΟΣ'Α mountaxn", "", " ", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([words, *texts])], "id int, text string")
    out, _ = S.corrected(df, most=most, count="n")
    got = {r.id: (r.text, r.n) for r in out.collect()}
    twice = ("winter, winter", 2) if most == 2 else ("wintxr, Wintxr", 0)
    want = [("(winter, mountain!", 2), ("evening\n evening  winter", 3), ("İwintxr İ mountain İ", 1), ("\U0001f600winter", 1), ("winter mountain", 1), twice, ("evͅenxng evening", 1), ("ΟΔΟΣ'Α mountain", 1), ("", 0), (" ", 0), (None, None)]
    assert [got[k] for k in range(1, len(want) + 1)] == want and got[0] == (words, 0)


def test_a_text_of_many_corrections_is_spelt_in_proportion(spark):
    """Before, each piece was looked for among all of its text's corrections, which grows with the square of the text."""
    known = ["abcdefghij", "klmnopqrst", "uvwxyzabcd", "mnbvcxzlkj"]
    rare = [w[:a] + x + w[a + 1 : b] + y + w[b + 1 :] for w in known for a in range(10) for b in range(a + 1, 10) for x in "éèêàâîïôûç" for y in "éèêàâîïôûçüö"]
    fixed = [w for w in known for _ in range(len(rare) // len(known))]
    df = spark.createDataFrame([(0, " ".join(known * 20)), (1, " ".join(rare))], "id int, text string")
    out, _ = S.corrected(df, count="n")
    assert {r.id: (r.text, r.n) for r in out.collect()}[1] == (" ".join(fixed), len(rare))
    assert "map_from_entries" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_postprocess_full_spells_at_places(spark):
    """Before, the pipeline's pieces were looked for among all of their text's corrections."""
    from inkwell.plans.postprocess import postprocess_full

    texts = ["A wintxr is near the mountaix here. A winter is near the mountain here. ", "", None, *(f"The winter mountain number {k} is near." for k in range(25))]
    out, found = postprocess_full(spark.createDataFrame(list(enumerate(texts)), "id int, text string"))
    got = {r.id: r.text for r in out.collect()}
    assert got == dict(enumerate(["A winter is near the mountain here.", *texts[1:]]))
    assert {(r.word, r.correction) for r in found.collect()} == {("mountaix", "mountain"), ("wintxr", "winter")}
    assert "map_from_entries" not in out._jdf.queryExecution().optimizedPlan().toString()
