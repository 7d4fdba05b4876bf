"""Work that must not grow with the square of a text: bounds that meet, and folds over batches."""

import random


from inkwell.operators import similarity


def test_bounds_that_meet_need_no_matrix(monkeypatch):
    """What a provider's faults make of a long text: before, each took the product of both lengths."""
    def none(a, b):
        raise AssertionError("a matrix")

    monkeypatch.setattr(similarity, "_matrix_distance", none, raising=False)
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdel") for _ in range(rng.randrange(2, 8))) + rng.choice(["", ".", "."]) for _ in range(30000))
    same = [("l", "1"), ("e", "c"), (".", ""), (" ", "")]
    for old, new in same:
        assert similarity.edit_distance(text, text.replace(old, new)) == text.count(old)
    assert similarity.edit_distance(text, text[: len(text) // 3]) == len(text) - len(text) // 3
    words = text.split()
    assert similarity.edit_distance(words, [w.replace("l", "1") for w in words]) == sum("l" in w for w in words)


def test_bounded_distance_equals_matrix():
    rng = random.Random(4)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(10))) for _ in "ab")
        b = rng.choice([b, a.replace("a", "x"), a.replace("b", ""), a[: len(a) // 2]])
        assert similarity.edit_distance(a, b) == similarity.edit_distance(list(a), list(b)) == similarity._matrix_distance(a, b)


def test_fields_and_token_distance(spark):
    from pyspark.sql import functions as F

    from inkwell.functions import text as T

    rows = spark.createDataFrame([("  a\t\nb  c d.", "a x c"), ("", ""), (" \n", "a b"), (None, "a")], "r string, h string")
    out = rows.select(T.fields("r").alias("f"), similarity.token_distance(T.fields("r"), T.fields("h")).alias("d")).collect()
    assert [(r.f, r.d) for r in out] == [(["a", "b", "c", "d."], 2), ([], 0), ([], 2), (None, None)]
    assert rows.select(F.size(T.fields("r")).alias("n")).first().n == 4


def test_cut_lines_of_high_pages(spark):
    """Before, a page's rows were an array each, searched again for every cut, and the cuts copied for every further one."""
    from inkwell.operators import layout

    def by_hand(h, blank, slice_height=880, offsets=(-100, -20, 60)):
        cuts = [0]
        while cuts[-1] + slice_height < h:
            tries = (cuts[-1] + slice_height + d for d in offsets)
            cuts.append(next((t for t in tries if t < h and blank(t)), cuts[-1] + slice_height))
        return [*cuts, h]

    high = [(1, 40_000_000), (2, 0), (3, 880), (4, 881), (5, 5000), (6, None)]
    out = layout.cut_lines(spark.createDataFrame(high, "page long, h int"), is_blank=lambda page, y: (y * 13 + page) % 31 == 0)
    found = {r.page: r.cuts for r in out.collect()}
    assert found == {page: None if h is None else by_hand(h, lambda y, page=page: (y * 13 + page) % 31 == 0) for page, h in high}

    rng = random.Random(5)
    rows = [(k, rng.randrange(9000), sorted(rng.sample(range(9000), 900)) if k % 7 else [], f"name {k}") for k in range(60)]
    given = layout.cut_lines(spark.createDataFrame(rows, "page long, h int, blank array<int>, name string"))
    assert given.columns == ["page", "h", "blank", "name", "cuts"]
    assert {r.page: r.cuts for r in given.collect()} == {page: by_hand(h, set(blank).__contains__) for page, h, blank, _ in rows}


def test_sessions_of_a_batch():
    """Before, every event of a batch was a row of its own object, and every session set a timer."""
    import pandas as pd

    from inkwell.streaming import sessions as S

    rng = random.Random(6)
    events = [(rng.choice([1, 2, None]), rng.randrange(3000), 1.0) for _ in range(300)]
    key, at, value = (pd.Series(list(c)) for c in zip(*events, strict=True))
    out = S.joined(key.astype("Int64"), at, value, 25)
    assert len(out) == 300 and S.joined(key[:0], at[:0], value[:0], 25).empty
    whole = out.assign(key=[k for k, _, _ in events]).dropna(subset=["n"])
    for k in (1, 2, None):
        own = whole[whole["key"].isna() if k is None else whole["key"] == k]
        assert sorted(tuple(r) for r in own[S.PART].itertuples(index=False)) == S.merged([(t, t, 1, v) for q, t, v in events if q == k], 25)


def test_alignment_compares_only_what_lies_on_its_path(monkeypatch):
    """Before, every sentence of the one side was compared with every like one of the other."""
    from inkwell.operators import consensus

    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghilmnorst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    first = [" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(600)]
    second = [s.replace("l", "1") for s in first]
    asked = []
    whole = consensus.ratio
    monkeypatch.setattr(consensus, "ratio", lambda a, b: asked.append(1) or whole(a, b))
    assert consensus.align(first, second) == (first, second)
    assert consensus.align(first, first[:400]) == (first, first[:400] + [""] * 200)
    assert len(asked) <= 1400


def test_near_duplicates_by_tokens_equal_a_scan():
    from inkwell.operators import consensus

    def scan(sentences, most=0.7):
        kept, tokens = [], []
        for s in sentences:
            own = set(s.split())
            hit = next((j for j, t in enumerate(tokens) if len(own & t) > most * max(1, min(len(own), len(t)))), None)
            if hit is None:
                kept.append(s)
                tokens.append(own)
            elif len(s) > len(kept[hit]):
                kept[hit], tokens[hit] = s, own
        return kept

    rng = random.Random(8)
    for _ in range(300):
        sentences = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(7))) for _ in range(12)]
        assert consensus.drop_near_duplicates(sentences) == scan(sentences)


def test_matching_ratio_equals_the_matcher(monkeypatch):
    """Before, every rare character of the one text was paired with all its places in the other, once a part of the text."""
    from difflib import SequenceMatcher

    rng = random.Random(9)
    letters = ["abc", "etaoinshrdlu" * 3 + "qxzjk", "".join(map(chr, range(0x4E00, 0x4E00 + 300))), "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ" * 3 + "éàçœ𝄞"]
    for _ in range(250):
        some = rng.choice(letters)
        a, other = (" ".join("".join(rng.choice(some) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 250))) for _ in "ab")
        b = rng.choice([other, a, a.replace("a", "1"), a.replace(" ", ""), a[: len(a) * 2 // 3], a[len(a) // 2 :] + a[: len(a) // 3], ""])
        a, b = rng.choice([(a, b), (b, a)])
        assert similarity.matching_ratio(a, b) == SequenceMatcher(None, a, b).ratio()

    def none(*_):
        raise AssertionError("the matcher")

    text = " ".join("".join(rng.choice(letters[1]) for _ in range(rng.randrange(2, 8))) for _ in range(20000))
    monkeypatch.setattr(similarity, "SequenceMatcher", none)
    assert similarity.matching_ratio(text, text) == 1.0
    for other in (text[: len(text) // 3], text.replace("l", "1"), text.replace(" ", "")):
        assert 0 < similarity.matching_ratio(text, other) < 1


def test_batches_of_long_texts_are_small(spark):
    """Before, a batch held 10,000 texts of any size."""
    import pandas as pd
    from pyspark.sql import functions as F

    from inkwell.operators import batches, consensus, lexicon, matching, providers
    from inkwell.operators.unicode import nfkc

    @F.pandas_udf("int")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    long = spark.range(40, numPartitions=1).select("id", F.repeat(F.lit("word "), 200_000).alias("text"))
    said = spark.createDataFrame([(1, ["a b"])], "doc_id long, sentences array<string>")
    c = F.col("text")
    bounding = [
        lambda: nfkc(c), lambda: similarity.array_distance(c, c), lambda: similarity.token_distance(F.split(c, " "), F.split(c, " ")),
        lambda: similarity.multiset_overlap(F.split(c, " "), F.split(c, " ")), lambda: similarity.matcher_ratio(c, c),
        lambda: providers.corrected(long, lambda line: []), lambda: consensus.without_near_duplicates(said), lambda: lexicon.canonical_case(long, ["word"]),
        lambda: matching.best_matches(said.withColumnRenamed("doc_id", "doc"), spark.createDataFrame([("t", "a b")], "target string, phrase string")),
    ]
    for bound in bounding:
        spark.conf.unset(batches.LIMIT)
        bound()
        assert spark.conf.get(batches.LIMIT) == str(batches.BYTES)
    assert max(r[0] for r in long.select(rows("text")).collect()) <= 5
    spark.conf.set(batches.LIMIT, "1000000")
    nfkc(c)
    assert spark.conf.get(batches.LIMIT) == "1000000"
    spark.conf.unset(batches.LIMIT)
