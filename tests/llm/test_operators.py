"""The training-data operators against brute force, exact round trips and held-out accuracy, odd inputs included."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkwell.llm import classifier, embed_dedup, html_extract, mixing, near_dup, packing, quality_rules, sharding, store, token_files, tokens, warc
from inkwell.llm.components import components
from inkwell.llm.textkit import column_texts, repeated_lines, words_in_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def vocabulary(rng, n=60):
    return [f"word{i}" for i in rng.permutation(400)[:n]]


@pytest.fixture(scope="module")
def rows():
    """Documents with nulls in every column, empty, blank and very long texts, ties, copies, near copies, repeats."""
    rng = np.random.default_rng(4)
    base = [" ".join(rng.choice(vocabulary(rng), 80)) + "\nend of it.\n" for _ in range(30)]
    texts: list[str | None] = [*base, base[0], base[0], base[1].replace("end", "fin"), None, "", " \t\n ", "one", "two words", "é ½\x85 日本 'll İ", LONG, "x " * 4000, "a\nb\na\n\nb\na"]
    texts += [base[2] + base[2], base[3].replace(" ", "  "), base[4] + " tail"]
    out = [(i, t, "en", f"src{i % 3}" if i % 5 else "src0", len(t or ""), "e") for i, t in enumerate(texts)]
    out += [(None, "no id here", None, None, None, None), (7, texts[7], "en", "src1", 1, "e"), (7, texts[7], "en", "src1", 1, "e")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_text_counts_equal_brute_force(rows):
    texts = [r[1] or "" for r in rows]
    for size in (200, 1 << 20):
        for lo, _, t in column_texts(pa.array(texts), size):
            lines, windows = repeated_lines(t), words_in_repeats(t, 8)
            for i in range(t.n):
                w = WORD.findall(texts[lo + i])
                real = [l for l in texts[lo + i].split("\n") if WORD.search(l)]
                seen = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
                inside = {k for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
                assert (t.n_words[i], lines[i], windows[i]) == (len(w), len(real) - len(set(real)), len(inside))


def test_quality_rules(spark, docs, rows, nothing):
    out = quality_rules.assess(docs.withColumn("kept", F.lit("clash")))
    got = out.collect()
    assert len(got) == len(rows) and "extra" in out.columns
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.assess(nothing).count() == 0
    bad = [(i, "short", "en", "bad", 0, "") for i in range(200)] + [(1000, " ".join(f"u{j}" for j in range(40)), "en", "bad", 0, "")]
    good = [(2000 + i, " ".join(f"u{j}" for j in range(40)), "en", f"good{i % 4}", 0, "") for i in range(200)]
    verdict = {r.doc_id: r.kept for r in quality_rules.assess(spark.createDataFrame(bad + good, DOCS)).collect()}
    assert not verdict[1000] and all(verdict[2000 + i] for i in range(200))  # a good page of a bad host goes


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_are_the_librarys(rows, name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    odd = ["  ", " \n", "\n\n", "\t ", " ", "'s", "'LL ", "12", "½", "<|endoftext|>", "é", " ́", "Σ ", "ß", "\x1c", "\x85", "日本", "🙂", " ", "\r\n", "​", "﻿", "ab", "Cd "]
    odd += ["'", "'re", "'so", "?'s", "''d", "'ll.", "a", "7", "Ⱥ", "ŉ", "²", "\x00", "\xad", "<|startoftext|>", "__", "'v", "'l", "e"]
    plain = [x for x in odd if max(map(ord, x)) < 0x180 and "<" not in x]
    texts = [r[1] or "" for r in rows] + ["".join(rng.choice(some, 30)) for some in (odd, plain) for _ in range(300)]
    got = list(tokens.load(path).many([*texts, None]))
    assert got == [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in [*texts, ""]]
    whole.encode_special_tokens = True
    as_text = tokens.encoder(path, special_tokens=False)
    for t in [*odd, "a <|endoftext|> b"]:
        assert as_text(t) == np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert tokens.load(path).size == whole.get_vocab_size()


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\r\n ", "\xa0"])
def test_long_white_space_is_encoded_and_packed(spark, run):
    text = "a b x" + run * (2_000_000 // len(run)) + "y é\n日" + run * 30_000
    encode = library("byte_bpe_50k.json")
    rows = [(1, text, "en", "s", 0, "e"), (2, run * 12_000, "en", "s", 0, "e")]
    out = packing.pack(spark.createDataFrame(rows, DOCS), public_tokenizers.path("byte_bpe_50k.json"), with_ids=True).collect()
    for doc, whole, *_ in rows:
        pieces = sorted((p for p in out if p.doc_id == doc), key=lambda p: p.start)
        assert np.array([i for p in pieces for i in p.ids], "<u4").tobytes() == encode(whole) + b"\0\0\0\0"


def library(name):
    """text -> ids by the library alone, as bytes."""
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: np.asarray(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing(spark, docs, rows, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [*rows, (50_000, "a<|endoftext|>b", "en", "s", 0, "e")]
    clash = docs.union(spark.createDataFrame(rows[-1:], DOCS)).withColumn("start", F.lit("clash")).withColumn("ids", F.lit("clash"))
    out = packing.pack(clash, path, with_ids=True).collect()
    encode = library("byte_bpe_50k.json")
    want = collections.Counter((r[0], zlib.crc32(encode(r[1] or "") + b"\0\0\0\0")) for r in rows)
    by_sequence = collections.defaultdict(list)
    for p in out:
        by_sequence[p.sequence_id].append(p)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda x: x.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and all(p.sequence_tokens == at for p in pieces)
    single = collections.defaultdict(list)
    for p in out:
        if want[p.doc_id, zlib.crc32(encode(next(r[1] for r in rows if r[0] == p.doc_id) or "") + b"\0\0\0\0")] == 1:
            single[p.doc_id].append(p)
    for doc, pieces in single.items():
        pieces.sort(key=lambda x: x.start)
        ids = [i for p in pieces for i in p.ids]
        assert np.array(ids, "<u4").tobytes() == encode(next(r[1] for r in rows if r[0] == doc) or "") + b"\0\0\0\0"
    assert packing.pack(nothing, path).count() == 0


def test_differencing_windows():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(1, 256, rng.integers(1, 200)).tolist()
        windows = packing.near_equal_windows(sizes, 1024)
        assert sorted(i for _, m in windows for i in m) == list(range(len(sizes)))
        assert all(s == sum(sizes[i] for i in m) <= 1024 for s, m in windows)
        assert len(windows) <= -(-sum(sizes) // 1024) + 2


def test_cuts_only_where_a_window_is_over():
    rng = np.random.default_rng(5)
    for n in [1, 2, 3, 7, *rng.integers(1, 513, 40).tolist()]:
        sizes = rng.integers(1, 1024, n).tolist()
        windows = packing.cut_to_windows(sizes, 1024, 256)
        assert all(0 < sum(hi - lo for _, (lo, hi) in w) <= 1024 for w in windows)
        for i, size in enumerate(sizes):
            at = 0
            for lo, hi in sorted(p for w in windows for k, p in w if k == i):
                assert lo == at < hi
                at = hi
            assert at == size
        assert len(windows) <= -(-sum(sizes) // 1024) * 1.03 + 2
    assert packing.cut_to_windows([1000, 24, 1023, 1], 1024, 256) == [[(0, (0, 1000)), (1, (0, 24))], [(2, (0, 1023)), (3, (0, 1))]]
    assert packing.cut_to_windows([], 1024, 256) == []


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header><nav><a href="/">Home</a></nav>
<div id="cookie-notice"><p>We use cookies, really. OK?</p></div><div class="content"><h2>Head</h2><p>First paragraph is long enough, with <b>marks, and<p>so on; it&nbsp;goes on &amp; on.
<ul><li>One<li>Two</ul><script>var a = "</p>";</script></div><div class="comments"><p>Nice, thanks! Great, loved it.</p></div><form><p>Subscribe, now.</p></form><footer>(c)</footer>"""


def test_html(spark, nothing):
    assert html_extract.main_text(PAGE) == "Head First paragraph is long enough, with marks, and so on; it goes on & on. One Two"
    cases = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain &lt;text"), (None, "u", "<p>a<br>b"), (5, "u", "<" * 5000), (5, "u", "<" * 5000), (6, "u", "<p>x</p>" * 20_000), (7, "u", "<!-- open <p>x")]
    out = html_extract.extract(spark.createDataFrame(cases, "page_id long, url string, html string")).collect()
    assert len(out) == len(cases) and all(r.n_chars == len(r.text) for r in out)
    got = {r.page_id: r.text for r in out}
    assert got[2] == got[3] == "" and got[4] == "plain <text" and got[None] == "a b" and len(got[6]) == 39_999
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_keeps_what_lies_beside_the_longest_block():
    long = "A sentence, with marks. " * 40
    body = f"<p>{long}</p><p>{long}</p>"
    flat = " ".join(long.split())
    assert html_extract.main_text(f"<body><div><h1>Title</h1><p>{long}</p><p>Short end.</p></div></body>") == f"Title {flat} Short end."
    assert html_extract.main_text(f"<div><h1>Title</h1><div>{long}</div></div>") == f"Title {flat}"
    assert html_extract.main_text(f"<h1>Title</h1><p>{long}</p><ul><li>One</ul>") == f"Title {flat} One"
    assert html_extract.main_text(f"<body><div><h1>Title</h1><p>A lead, of some length.</p><div>{body}</div><ul><li>One</ul></div><nav>Home</nav></body>") == f"Title A lead, of some length. {flat} {flat} One"


LONG_TEXT = "A sentence, with marks and more. " * 20
FLAT = " ".join(LONG_TEXT.split())


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><h1>T</h1><p>{LONG_TEXT}</p><section id='discussion'><p>{LONG_TEXT}</p></section></article>", f"T {FLAT} {FLAT}"),
        (f"<article><p>{LONG_TEXT}</p><h2 id='related-work'>Related work</h2><p class='ad-hoc'>An ad hoc note, kept.</p><p>{LONG_TEXT}</p></article>", f"{FLAT} Related work An ad hoc note, kept. {FLAT}"),
        (f"<article><p>{LONG_TEXT}</p><div class='x1'><b>SHARE</b> <a href='#'>ONE</a><a href='#'>TWO</a></div><p>{LONG_TEXT}</p></article>", f"{FLAT} {FLAT}"),
        (f"<body><div class='q1'><a href='/'>Home</a> <a href='/n'>News</a></div><div class='q2'><h1>T</h1><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p><p>End.</p></div><div class='q3'>Site 2024</div></body>", f"T {FLAT} {FLAT} End."),
        (f"<body class='sidebar-left'><div class='content comments-enabled'><h1>T</h1><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div><div class='comments'><p>Nice, thanks! Great, loved it.</p></div></body>", f"T {FLAT} {FLAT}"),
        (f"<main><p>{LONG_TEXT}</p><div class='ad'>Buy this, now. It is cheap, really.</div><h3>Also read</h3><ul><li><a href='/1'>One thing</a><li><a href='/2'>Another</a></ul></main>", FLAT),
    ],
)
def test_html_nodes_are_chosen_by_their_paths(page, want):
    assert html_extract.main_text(page) == want


PARAGRAPHS = f"<p>{LONG_TEXT}</p><p>{LONG_TEXT}</p>"
COMMENTS = "".join(f"<div class='c{i}'><b>user{i}</b><p>I liked this, thanks. Great!</p></div>" for i in range(6))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # teaser cards marked as articles below a text in a div
        (f"<body><div class='x'><h1>T</h1>{PARAGRAPHS}</div><article><p>Short teaser, here.</p></article><article><h3>More</h3><p>Another, short.</p></article></body>", f"T {FLAT} {FLAT}"),
        # a main article and cards that are articles too, inside main
        (f"<main><article><h1>T</h1>{PARAGRAPHS}<p>End.</p></article><article><h3>More</h3><p>Another, short.</p></article></main>", f"T {FLAT} {FLAT} End."),
        # several articles of like length all stay
        (f"<main><article><h2>One</h2>{PARAGRAPHS}</article><article><h2>Two</h2>{PARAGRAPHS}</article></main>", f"One {FLAT} {FLAT} Two {FLAT} {FLAT}"),
        # a form around the whole page, one within it, and one that is the page's least part
        (f"<body><form id='aspnetForm'><div id='m'><h1>T</h1>{PARAGRAPHS}</div><div><form><p>Subscribe, now.</p></form></div></form></body>", f"T {FLAT} {FLAT}"),
        (f"<body><h1>T</h1>{PARAGRAPHS}<form><div><p>Write to us, please. We answer, soon.</p></div></form></body>", f"T {FLAT} {FLAT}"),
        # neutral boxes beside the text: a cookie line, a rights line, an advert between two paragraphs
        (f"<body><div class='page'><h1>T</h1>{PARAGRAPHS}<div class='q'>We use cookies, to serve you.</div><div class='z'>All rights reserved.</div></div></body>", f"T {FLAT} {FLAT}"),
        (f"<article><h1>T</h1><p>{LONG_TEXT}</p><div class='box'>Buy this, now. It is cheap.</div><p>{LONG_TEXT}</p></article>", f"T {FLAT} {FLAT}"),
        # reader comments under a name that is not common
        (f"<body><div class='page'><h1>T</h1>{PARAGRAPHS}</div><section class='user-feedback'>{COMMENTS}</section></body>", f"T {FLAT} {FLAT}"),
        (f"<article><h1>T</h1>{PARAGRAPHS}<section class='voices'>{COMMENTS}</section></article>", f"T {FLAT} {FLAT}"),
        # links of sources belong to the article, others do not; a table's cells do
        (f"<article><h1>T</h1>{PARAGRAPHS}<h2>Sources</h2><ul><li><a href='#'>A book</a><li><a href='#'>A paper</a></ul></article>", f"T {FLAT} {FLAT} Sources A book A paper"),
        (f"<article><h1>T</h1>{PARAGRAPHS}<h2>Top stories</h2><ul><li><a href='#'>A book</a><li><a href='#'>A paper</a></ul></article>", f"T {FLAT} {FLAT}"),
        (f"<article><p>{LONG_TEXT}</p><table><tr><td>Year<td>Sum<tr><td>1999<td>12</table><p>{LONG_TEXT}</p></article>", f"{FLAT} Year Sum 1999 12 {FLAT}"),
        # nothing but short texts, one text, no text
        ("<body><article><p>Short.</p></article></body>", "Short."),
        ("<article></article><p>x</p>", "x"),
        ("<form><input><p>Name</p></form>", ""),
    ],
)
def test_html_ratio_decides_beside_tags(page, want):
    assert html_extract.main_text(page) == want


def test_html_deep_pages_cost_no_more_than_flat_ones():
    import time

    began = time.process_time()
    assert html_extract.main_text("<div>x" * 50_000).count("x") == 50_000
    assert html_extract.main_text("<div><b>" * 50_000 + "x" + "</p></b>" * 50_000) == "x"
    assert time.process_time() - began < 30


def test_html_path_ratios_equal_brute_force():
    page = html_extract.parse(f"<body><div class='a'><p>{LONG_TEXT}</p><p>One, <a href='#'>two.</a></p></div><div class='ads'><p>Buy, now.</p></div><ul><li><a href='#'>x</a></ul></body>")
    ratios = html_extract.path_ratios(page, page.nodes)
    by_path = collections.defaultdict(list)
    for x in page.nodes:
        by_path[x.path].append(x)
    assert [len(v) for v in by_path.values()] == [2, 1, 1]
    want = []
    for members, factor, linked in zip(by_path.values(), (1, html_extract.MARKED, 1), (4, 0, 1), strict=True):
        chars = sum(len(x.text) for x in members)
        marks = sum(c in ",." for x in members for c in x.text)
        want.append((chars / len(members) * np.log(1 + marks / len(members)) * (chars - linked) / chars * factor, linked / chars))
    assert np.allclose([ratios[p] for p in by_path], want)
    kernel = [np.exp(-k * k / 2) for k in range(-2, 3)]
    raw = [ratios[x.path][0] for x in page.nodes]
    smooth = [sum(w * raw[min(max(i + k, 0), len(raw) - 1)] for w, k in zip(kernel, range(-2, 3), strict=True)) / sum(kernel) for i in range(len(raw))]
    passed = {x.path for x, r, s in zip(page.nodes, raw, smooth, strict=True) if (r if ratios[x.path][1] >= 1 / 3 or x.path == page.nodes[2].path else s) >= 0.5 * np.std(smooth)}
    assert html_extract.content_paths(page, page.nodes) == passed == {page.nodes[0].path}


def brute_classes(rows):
    """Class of each row by all pairs and exact J_P."""
    bags = []
    for r in rows:
        w = WORD.findall(r[1] or "")
        grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        bags.append(collections.Counter(grams))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] is not None and rows[j][1] is not None and WORD.findall(rows[i][1]) == WORD.findall(rows[j][1])
            a, b = bags[i], bags[j]
            jp = sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in set(a) | set(b)) for d in a.keys() & b.keys()) if not same and a.keys() & b.keys() else 0
            if same or jp >= near_dup.THRESHOLD:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def test_near_duplicates_equal_brute_force(spark, docs, rows, nothing):
    short = [r if r[1] is None or len(r[1]) < 20_000 else (r[0], r[1][:900], *r[2:]) for r in rows]
    table = spark.createDataFrame(short, DOCS).repartition(3)
    out = near_dup.near_duplicates(table).collect()
    want = collections.defaultdict(set)
    for r, c in zip(short, brute_classes(short), strict=True):
        want[c].add(r[0])
    got = collections.defaultdict(set)
    for r in out:
        got[r.class_id if r.doc_id is not None else "null"].add(r.doc_id)
    assert sorted(map(sorted, (s for s in want.values() if None not in s))) == sorted(map(sorted, (s for s in got.values() if None not in s)))
    assert len(out) == len(rows)
    kept = near_dup.keep_one(table)
    assert kept.count() == len(want) and kept.columns == table.columns
    assert near_dup.near_duplicates(nothing).count() == 0 and near_dup.keep_one(nothing).count() == 0


def test_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(8)
    base = [f"t{i}" for i in range(200)]

    def near(k):
        w = list(base)
        for i in rng.integers(0, 200, 2):
            w[i] = f"n{k}_{i}"
        return " ".join(w)

    rows = [(k, near(k)) for k in range(300)]
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = [(d, t, "", "", 0, "") for d, t in rows]
    assert len({r.class_id for r in out}) == len(set(brute_classes(whole[:80]))) == 1


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in list(parent)}


def test_shards(docs, rows, nothing):
    placed = sharding.assign(docs.withColumn("shard", F.lit("clash")), 4, ties=("text",), slot_rows=5).collect()
    assert len(placed) == len(rows)
    sizes = collections.Counter(r.shard for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == {0, 1, 2, 3}
    for s in sizes:
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(sizes[s]))
    for source in {r[3] for r in rows}:
        n = collections.Counter(r.shard for r in placed if r.source == source)
        assert max(n.values()) - min(n[s] for s in sizes) <= 2
    again = sharding.assign(docs.repartition(7), 4, ties=("text",), slot_rows=50).collect()
    assert sorted((r.doc_id or -1, r.text or "", r.shard, r.slot) for r in placed) == sorted((r.doc_id or -1, r.text or "", r.shard, r.slot) for r in again)
    assert sharding.assign(nothing, 4).count() == 0


def test_shards_of_many_small_sources(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, F.concat(F.lit("s"), "id")).when(F.col("id") < 4000, F.concat(F.lit("t"), F.floor(F.col("id") / 2))).otherwise("big").alias("source"))
    got = sharding.assign(rows, 4, slot_rows=100).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(4) for k in range(1500)]
    big = collections.Counter(r.shard for r in got if r.source == "big")
    assert max(big.values()) - min(big.values()) <= 2
    again = sharding.assign(rows.repartition(5), 4, slot_rows=100_000).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    alike = rows.withColumn("share", F.lit(0.5)).withColumn("turn", sharding.ranks.hash_key("doc_id", 1))
    sizes = sharding.ranks.dealt(alike, "share", [], 60, "turn", 100).groupBy("__slot", "__value", "__part").count().collect()
    assert len(sizes) == 60 and max(r["count"] for r in sizes) <= 200


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while free:
        level = (share * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        target |= {s: most * sizes[s] for s in full} if full else {s: level * weight[s] for s in free}
        free -= full or free
    return target


def test_mix(docs, rows, nothing):
    got = mixing.plan(docs.withColumn("target", F.lit("clash")), slot_rows=7).collect()
    assert len(got) == len(rows)
    counts = collections.Counter()
    for r in rows:
        counts[r[3]] += len(WORD.findall(r[1] or ""))
    want = brute_targets(dict(counts))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == counts[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in want)
    assert mixing.plan(nothing).count() == 0
    sizes = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    assert sum(sizes.values()) > 0
    copies = mixing.materialise(docs, mixing.plan(docs.select("doc_id", "text", "source")))
    assert copies.columns == docs.columns and copies.count() > 0


def test_warc_round_trip_with_magic_in_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    payloads = ["<p>plain</p>", None, "", "x WARC/1.1\r\n y" * 3, fake, fake * 2 + "tail", "WARC/1.1\r\n", "\r\n\r\n", "é日本" * 50, "é日本" * 50, "short", "short", fake * 4, fake * 4, "z" * 50_000]
    pages = [(i, f"http://a/{i}\r\nX: y" if i % 2 else None, p, "e") for i, p in enumerate(payloads)] + [(0, None, payloads[0], "e")]
    path = store.fresh_path(spark, "archive")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string, extra string").coalesce(2), path)
    for split in ("64", "1000", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            got = sorted(map(tuple, warc.resolved(warc.read(spark, path)).collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        want, first = [], {}
        for i, _, p, _ in pages:
            b = (p or "").encode()
            d = hashlib.sha256(b).hexdigest()
            ref = first.setdefault(d, i) if len(b) >= 100 else i
            want.append((i, len(b), d, "response" if ref == i else "revisit", None if ref == i else ref))
        key = lambda t: tuple(str(x) for x in t)
        assert sorted(got, key=key) == sorted(want, key=key)


def test_warc_rows_of_one_id_keep_their_payloads(spark):
    pages = [(1, "u", "A" * 200), (5, "u", "A" * 200), (5, "u", "B" * 200), (None, "u", "A" * 200), (7, "u", "B" * 200), (7, "u", "C" * 99)]
    path = store.fresh_path(spark, "archive")
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    got = warc.resolved(warc.read(spark, path)).collect()
    sha = {c: hashlib.sha256((c * n).encode()).hexdigest() for c, n in (("A", 200), ("B", 200), ("C", 99))}
    want = [(1, 200, sha["A"], "response", None), (5, 200, sha["A"], "revisit", 1), (5, 200, sha["B"], "response", None), (None, 200, sha["A"], "response", None), (7, 200, sha["B"], "revisit", 5), (7, 99, sha["C"], "response", None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path + "-none")
    assert warc.resolved(warc.read(spark, path + "-none")).count() == 0


def test_classifier_held_out(spark, nothing):
    rng = np.random.default_rng(6)
    voc = vocabulary(rng, 300)
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        w = rng.choice(voc, rng.integers(5, 120)).tolist()
        rows.append((i, ". ".join(" ".join(w[k : k + 9]) for k in range(0, len(w), 9)) if good else " ".join(x + "###" for x in w), "en", "s", 0, "e"))
        labels.append((i, int(good)))
    table = spark.createDataFrame(rows + [(None, None, None, None, None, None), (9999, "", "en", "s", 0, "e"), (9998, LONG, "en", "s", 0, "e")], DOCS)
    known = spark.createDataFrame([l for l in labels if l[0] % 4] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = classifier.train(table, known)
    out = {r.doc_id: r for r in classifier.score(table.withColumn("score", F.lit("clash")), model).collect()}
    held = [(out[i].predicted, y) for i, y in labels if i % 4 == 0]
    assert np.mean([p == y for p, y in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == 603
    none = classifier.train(table, known.limit(0))
    assert none.score(np.zeros((2, len(classifier.FEATURES)))).tolist() == [0.5, 0.5]
    assert classifier.score(nothing, model).count() == 0


def test_discriminant_equals_the_definition():
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(0, [1, 2, 0.5], (40, 3)), rng.normal(1, [2, 1, 1], (70, 3))])
    y = np.repeat([0, 1], [40, 70])
    pooled = sum((y == c).mean() * np.cov(x[y == c].T, bias=True) for c in (0, 1))
    odds = np.log(70 / 40)
    for c, sign in ((0, -1), (1, 1)):
        shrunk = 0.98 * (0.8 * np.cov(x[y == c].T, bias=True) + 0.2 * pooled) + 0.02 * np.diag(np.diag(pooled))
        away = x - x[y == c].mean(0)
        mahalanobis = np.einsum("ij,jk,ik->i", away, np.linalg.inv(shrunk), away)
        odds = odds - sign * 0.5 * (mahalanobis + np.linalg.slogdet(shrunk)[1])
    assert np.allclose(classifier.fit(x, y).score(x), 1 / (1 + np.exp(-odds)), atol=1e-9)


def test_training_rows_are_bounded_where_ids_repeat(spark):
    rows = [(k % 4, f"word {k % 4} again", "en", "s", 0, "e") for k in range(200)] + [(None, "no id", "en", "s", 0, "e")]
    known = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    x, y = classifier.training_rows(spark.createDataFrame(rows, DOCS), known, "doc_id", "text", "quality", 3)
    assert len(x) == len(y) == 3 and np.isfinite(x).all()


def brute_links(rows):
    groups = collections.defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if v is None or label is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        groups[label, len(v)].append(i)
    near = [set() for _ in rows]
    for members in groups.values():
        for i in members:
            for j in members:
                a, b = (np.array(rows[k][1], float) / max(map(abs, rows[k][1])) for k in (i, j))
                if i != j and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93:
                    near[i].add(j)
    return near


@pytest.mark.parametrize("leaf", [512, 40])
def test_embeddings_equal_brute_force(spark, leaf):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] + rng.normal(size=16) * 0.16).tolist(), i % 2) for i in range(600)]
    rows += [(600 + i, rows[0][1], 0) for i in range(5)] + [(700, None, 0), (701, [0.0] * 16, 0), (702, [float("nan")] * 16, 0), (703, [None] + [1.0] * 15, 0), (704, rows[0][1], None), (705, [], 0), (706, [1.0, 2.0], 0), (707, [2.0, 4.0], 0), (708, [1e300] * 16, 1), (708, [1e300] * 16, 1)]
    table = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<double>, label int, kept string").repartition(3)
    out = {r.vec_id: r for r in embed_dedup.linked(table, leaf_rows=leaf).collect()}
    near = brute_links(rows)
    found, want = sum(out[r[0]].n_links for r in rows), sum(map(len, near))
    assert found <= want and found >= (want if leaf == 512 else 0.95 * want)
    assert out[701].n_links == out[702].n_links == out[703].n_links == out[704].n_links == 0 and out[701].kept
    assert out[706].component_id == out[707].component_id == 706 and out[600].component_id == out[0].component_id
    assert embed_dedup.linked(table.limit(0)).count() == 0


def test_leaves_stay_small_as_vectors_grow(spark):
    rng = np.random.default_rng(12)
    largest = []
    for n in (600, 6000):
        centre = rng.normal(size=(n // 3, 24))
        rows = [(i, (centre[i % len(centre)] + rng.normal(size=24) * 0.2).tolist(), 0) for i in range(n)]
        rows += [(n + i, (centre[0] + rng.normal(size=24) * 1e-3).tolist(), 0) for i in range(400)]
        vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        nodes = store.cut(embed_dedup._as_bytes(vectors.select("vec_id", F.col("label").cast("string"), "embedding")).withColumnRenamed("vec_id", "node"))
        sample = embed_dedup._unit([bytes(r.vec) for r in nodes.limit(256).collect()], 24)
        forests = {("0", 24): embed_dedup.grow(sample, 4, 0.93)}
        placed = embed_dedup.indexed(nodes, forests, 64, 0.93)
        per_leaf = placed.groupBy("leaf").agg(F.count(F.when(F.col("node") < n, 1)).alias("others"), F.count(F.when(F.col("node") >= n, 1)).alias("dense")).collect()
        # no cut divides the dense group, which keeps no more others than it has itself
        assert all(r.others <= r.dense for r in per_leaf if r.others + r.dense > embed_dedup.OVERFULL * 64)
        largest.append(max(r.others for r in per_leaf if not r.dense))
        assert placed.select("node").distinct().count() == n + 400
        if n == 6000:
            out = {r.vec_id: r.n_links for r in embed_dedup.linked(vectors, leaf_rows=64, sample_rows=256).collect()}
    assert max(largest) <= embed_dedup.OVERFULL * 64
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.93).sum() - len(x)
    assert want >= sum(out.values()) >= 0.95 * want


def test_token_files_round_trip(spark, docs, rows, nothing):
    path, out = public_tokenizers.path("word_bpe_49k.json"), store.fresh_path(spark, "tokens")
    rows = [*rows, (50_000, "a<|endoftext|>b", "en", "s", 0, "e"), *((None, f"no id {i}", None, None, None, None) for i in range(40))]
    clash = spark.createDataFrame(rows, DOCS).repartition(3).withColumn("part", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    manifest = token_files.write(clash, path, out, sequence_length=64, range_bytes=20_000)
    got = token_files.read_documents(spark, manifest, out).orderBy("start").collect()
    encode = library("word_bpe_49k.json")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for r, g in zip(ordered, got, strict=True):
        ids = encode(r[1] or "") + np.array([1], "<u4").tobytes()
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r[0], at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    first = manifest.orderBy("part").first()
    ids, mask = token_files.read_sequence(first.ids_file, 0)
    assert len(ids) == len(mask) == 64
    want = np.frombuffer(b"".join(encode(r[1] or "") + np.array([1], "<u4").tobytes() for r in ordered), "<u4")
    assert (ids[mask] == want[: mask.sum()]).all()
    empty = token_files.write(nothing, path, store.fresh_path(spark, "tokens"))
    assert token_files.read_documents(spark, empty, out).count() == 0


def test_pipeline_stages_keep_their_columns(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(240):
        w = rng.choice(vocabulary(rng, 300), 60).tolist()
        good = i % 4 > 0
        rows.append((i, ". ".join(" ".join(w[k : k + 9]) for k in range(0, 60, 9)) if good else " ".join(x + "###" for x in w), "en", f"s{i % 3}", 0))
        labels.append((i, int(good), 0))
    rows += [(1000 + i, rows[1][1], "en", "s1", 0) for i in range(9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == before.columns
        ids = {r.doc_id for r in docs.collect()}
        if k == 0:
            assert ids == {r[0] for r in rows if r[0] >= 1000 or r[0] % 4}
        if k == 2:
            assert not any(i >= 1000 for i in ids) and 1 in ids and len(ids) == 180
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_takes_odd_rows(spark, tmp_path):
    import corpus_pipeline

    clash = "score string, predicted string, kept string, size string, taken string, start string, sequence_id string, component_id string"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {clash}"
    more = ("c",) * 8
    rng = np.random.default_rng(12)
    good = [". ".join(" ".join(rng.choice(vocabulary(rng, 300), 9)) for _ in range(7)) for _ in range(80)]
    rows = [(i, t, "en", f"s{i % 2}", 1, *more) for i, t in enumerate(good)] + [(100 + i, " ".join(w + "###" for w in t.split()), "en", "s0", 1, *more) for i, t in enumerate(good[:40])]
    odd = [(None,) * 13, (None, good[0], None, None, None, *[None] * 8), (300, "", "en", None, 0, *more), (301, " \n\t", "en", "", 0, *more), (302, ". ".join(good) * 40, "en", "s1", 0, *more), (5, good[5], "en", "s1", 1, *more)]
    spark.createDataFrame(rows + odd, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(80)] + [(100 + i, 0, 0) for i in range(40)] + [(None, 1, None), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    last = docs.select("doc_id", "text").collect()
    assert not any(t is None or not t.strip() for _, t in last)
    assert {d for d, _ in last if d is not None} <= {*range(80), 302}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {d for d, _ in last}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0
