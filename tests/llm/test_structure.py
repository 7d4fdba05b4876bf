"""Conversation repair, fill-in-middle and language identification against brute force and held-out labels."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.llm import conversations, fim, langid
from inkwell.llm.textkit import column_texts

SPACE = re.compile(r"[^\x20\x09-\x0D]")


# --- conversations ------------------------------------------------------------------------

STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FILLS = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def least_repair(rows):
    """(cost, letters, lines) by trying every edit of every row from the front; rows are (role, text, first fault)."""

    def inserted(best):
        for _ in range(4):
            for q, (c, s, lines) in list(best.items()):
                new = (c + 3, s + "I", (*lines, FILLS[q] + ":"))
                to = STEPS[q, FILLS[q][0]]
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    best = inserted({0: (0, "", ())})
    for role, text, fault in rows:
        new = {}
        for q, (c, s, lines) in best.items():
            options = [(q, (c + 4, s + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if (q, role[:1]) in STEPS:
                    options.append((STEPS[q, role[:1]], (c + more, s + "K", (*lines, f"{role}:{text}"))))
                options.append((STEPS[q, FILLS[q][0]], (c + more + 3, s + "R", (*lines, f"{FILLS[q]}:{text}"))))
            for to, way in options:
                if to not in new or way < new[to]:
                    new[to] = way
        best = inserted(new)
    return min(best[q] for q in (0, 3) if q in best)


def expected(rows):
    """The report of one conversation's rows of (turn, role, text)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or " " if r[1] is None else r[1], hashlib.sha256((" " if r[2] is None else r[2]).encode()).hexdigest()))
    seen, marked = set(), []
    for _, role, text in order:
        role, text = (" " if x is None else x for x in (role, text))
        last = SPACE.findall(text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    cost, audit, lines = least_repair(marked)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds = collections.Counter(f for _, _, f in marked)
    initials = [r[:1] for r, _, _ in marked]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def turns():
    """Conversations with nulls in every column, ties, repeated rows, blank and very long texts, one row and many."""
    rng = random.Random(7)
    out = []
    for conv in [None, *range(9)]:
        for t in range(rng.choice([1, 2, 7, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "u2", "", "tool"])
            out.append((conv, rng.choice([None, t, t, t, t + 1]), role, rng.choice(["Hi.", "ok", "", None, "a b? \n", "x!\t", f"t{t}.", f"t{t}", " \n\t", "é…"])))
    return out + [(3, 2, "user", "same.")] * 30 + [(77, None, None, None)] * 5 + [(78, 1, "user", "word " * 200_000 + "."), (79, -5, "assistant", "."), (79, 5, "user", "x")]


def test_repairs_equal_brute_force():
    rng = random.Random(1)
    names = {"s": "system", "u": "user", "a": "assistant", "-": "other"}
    kinds = {"blank": conversations.BLANK, "duplicate": conversations.DUPLICATE, "truncated": conversations.TRUNCATED, "": conversations.FINE}
    for _ in range(1500):
        rows = [(rng.choice("suua-a"), rng.choice(["blank", "duplicate", "truncated", "", "", ""])) for _ in range(rng.randint(0, 9))]
        got = conversations.cheapest(conversations.CHAT, [(i, kinds[f]) for i, f in rows])
        assert got == least_repair([(names[i], "t", f) for i, f in rows])[:2]


@pytest.mark.parametrize("limits", [{}, {"max_rows": 1, "chunk_bits": 2}, {"max_bytes": 20, "chunk_bits": 1}])
def test_reports_equal_brute_force(spark, turns, limits):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("clash")).withColumn("pos", F.lit("clash")).repartition(3)
    got = {r.conv_id: tuple(r[1:]) for r in conversations.report(df, **limits).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    by_conv = collections.defaultdict(list)
    for conv, *row in turns:
        by_conv[conv].append(tuple(row))
    assert got == {conv: expected(rows) for conv, rows in by_conv.items()}


def test_repaired_turns_are_what_the_digest_says(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    digests = {r.conv_id: r.repaired_sha256 for r in conversations.report(df).collect()}
    for limits in ({}, {"max_rows": 1, "chunk_bits": 2}):
        lines = collections.defaultdict(list)
        for r in sorted(conversations.repair(df, **limits).collect(), key=lambda r: (str(r.conv_id), r.place)):
            lines[r.conv_id].append(f"{r.role}:{r.text}")
            assert r.edit in "KRI" and (r.edit != "I" or (r.turn is None and r.text == ""))
        assert digests == {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in digests}


def test_damage_and_conversations_without_rows(spark):
    import zlib

    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}! of? {c}.") for c in range(60) for t in range(2)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        want += [(c, t, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, conversations.damaged(df).collect()), key=key) == sorted(want, key=key)
    got = {r.conv_id: r for r in conversations.audited(df).collect()}
    assert set(got) == {c for c, *_ in rows}
    gone = set(got) - {c for c, *_ in want}
    for c in gone:
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.audited(df.limit(0)).count() == 0
    assert conversations.repair(df.limit(0)).count() == 0


# --- fill in middle -----------------------------------------------------------------------

PATTERN = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s).", "word": r"(?s)\A[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"}


def plain_fim(text, doc_id, unit, fim_percent, spm_percent):
    units = re.findall(PATTERN[unit], text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm_percent else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize(("unit", "fim_percent", "spm_percent"), [("line", 100, 50), ("word", 60, 0), ("char", 100, 100)])
def test_fill_in_middle_equals_brute_force(spark, unit, fim_percent, spm_percent):
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n", "a", "a\n", "no end", "<P>", "x <M> y\nz", "<S", "S>", "\x00\n\x00", "日本\n🙂🙂\n", "\r\n x\x85\n", "w\n" * 40_000, "é" * 100_000]
    texts += ["".join(rng.choice("ab <\n é日🙂\tP>") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = [(i, t, "clash", "c") for i, t in enumerate(texts)] + [(None, "null id\nof two", None, None), (4, "a", "x", "y"), (4, "a", "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, extra string").repartition(3)
    out = fim.transform(df, unit=unit, fim_percent=fim_percent, spm_percent=spm_percent)
    assert "extra" in out.columns and "text" not in out.columns
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())
    assert got == collections.Counter((i, *plain_fim(t or "", i, unit, fim_percent, spm_percent)) for i, t, *_ in rows)
    back = collections.Counter((r.doc_id, r.text) for r in fim.restore(out).collect())
    assert back == collections.Counter((i, t or "") for i, t, *_ in rows)
    assert fim.restore(fim.transform(df.limit(0))).count() == 0


def test_digests_are_of_outputs(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, None)], "doc_id long, text string")
    for r in fim.digests(df).collect():
        text = {1: "a\nb\nc", 2: ""}[r.doc_id]
        assert r.output_sha256 == hashlib.sha256(plain_fim(text, r.doc_id, "line", 100, 50)[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_select_finds_every_rank():
    rng = random.Random(9)
    for width in (1, 2, 63, 64, 65, 1000):
        bits = rng.getrandbits(width) | 1
        places = [i for i in range(width) if bits >> i & 1]
        assert [fim.select(bits, width, k) for k in range(len(places))] == places


# --- languages ----------------------------------------------------------------------------


def test_ngrams_equal_brute_force():
    texts = ["Ab é1c", None, "", "zz", "日 a-b", "12 !", "x" * 5000]
    for _, _, t in column_texts(langid.prepared(pa.array(texts))):
        counts = [collections.Counter() for _ in texts]
        for place, before in langid.grams(t):
            for i in range(t.n):
                counts[i].update(place[before[i] : before[i + 1]].tolist())
        for i, text in enumerate(texts):
            raw = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in f" {(text or '').lower()} ".encode())
            n = sum(1 for w in (2, 3, 4) for k in range(len(raw) - w + 1) if 0x20 not in raw[k + 1 : k + w - 1] and raw[k : k + w].strip())
            n -= sum(1 for w in (3, 4) for k in range(len(raw) - w + 1) if raw[k] == raw[k + w - 1] == 0x20 and 0x20 not in raw[k + 1 : k + w - 1])
            assert counts[i].total() == n, text


def test_machine_is_at_its_least():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 20)).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=200) > 0.2, 1.0, -1.0)
    w = langid.machine(x, y, c=5.0)
    wide = np.hstack([x, np.ones((200, 1))])
    share = 5.0 * np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    value = lambda v: 0.5 * v @ v + (share * np.maximum(0, 1 - y * (wide @ v)) ** 2).sum()
    assert all(value(w) <= value(w + rng.normal(size=21) * size) for size in (1e-2, 0.1, 1) for _ in range(50))
    assert (np.sign(wide @ w) == y).mean() > 0.9


def test_family_first_then_pairs():
    model = langid.Model(("de", "en", "es", "fr"), ((0, 1), (2, 3)), ((0, 1), (2, 3)), np.zeros((langid.DIMS, 4)), np.zeros(4))
    # machines: germanic, romance, de or en, es or fr
    at, score = model.predict(np.array([[2, -2, -1, 3], [-1, 1, 5, -0.5], [1.0, -1, 1, 0]]))
    assert [model.languages[i] for i in at] == ["en", "fr", "de"] and ((score > 0) & (score <= 1)).all()
    assert langid.family_of("de-AT") == langid.family_of("en") != langid.family_of("fr") and langid.family_of("xx") == "only xx"


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    model = langid.train(docs.where(fold != 0))
    got = langid.predict(docs.where(fold == 0), model).select("lang", "lang_pred").collect()
    assert len(got) > 150 and sum(a == b for a, b in got) >= 0.98 * len(got)


def test_language_of_odd_rows(spark):
    words = {"en": "the of and that with", "de": "der und nicht ein über", "es": "el que los para años", "fr": "les des une été pour"}
    rng = random.Random(3)
    rows = [(f"{lang}{i}", " ".join(rng.choices(words[lang].split(), k=30)), lang, 0.5) for lang in words for i in range(30)]
    rows += [("same", rows[0][1], "en", 1.0)] * 50 + [("n", None, "en", None), ("e", "", "en", None), ("d", "12 -- 34", "de", None), ("u", "der und nicht", None, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, score double").repartition(3)
    model = langid.train(df)
    odd = [(None, None), ("a", ""), ("b", "1234 ..."), ("c", "der und nicht"), ("d", "the of " * 200_000), ("e", "los años"), ("f", "ÉTÉ DES UNE")]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame([(*r, 0.1, "x") for r in odd], "doc_id string, text string, score double, extra string"), model).collect()}
    assert [got[k].lang_pred for k in (None, "a", "b", "c", "d", "e", "f")] == ["und", "und", "und", "de", "en", "es", "fr"]
    assert got[None].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(df.limit(0), model).count() == 0
    untaught = langid.train(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, untaught).collect()} == {"und"}
    one = langid.train(df.where("lang = 'fr'"))
    assert {r.lang_pred for r in langid.predict(df.where("lang = 'es'"), one).collect()} == {"fr"}


def test_training_rows_are_bounded(spark):
    rows = [(f"word{i} some text {chr(97 + i % 26)}", "en" if i % 3 else "de") for i in range(2000)] + [("one text", "en")] * 3000
    x, langs = langid.training_rows(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 400, 10, 2)
    assert len(x) <= 400 and set(langs) == {"en", "de"} and abs(langs.count("de") - 200) < 60
