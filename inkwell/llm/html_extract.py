"""Main text of pages by tag-path ratios.

A page is read once into text nodes, each with its path of block tags from the root.  Per
path, the length of text and the number of punctuation marks are summed and divided by
the path's nodes; text inside links counts against it, and so do class and id words of
boilerplate, as a factor.  The fused ratio is smoothed over the nodes in page order and
thresholded: nodes of paths above it are content.  Each ``article`` or ``main`` has paths of
its own, so that a card's share no ratio with the article's; where such elements hold most of
the text outside links and marked paths, what lies outside them goes.  Beside the passing
nodes stay, within the deepest container around all of them, headings before what stays, texts
that are neither links nor marked and lie in no container further in, and lists of links under
a heading of sources.
What is boilerplate by its tag, its role or because it is hidden is never looked at; a form is
boilerplate unless it is wrapped around containers that hold most of the page's text.

Time and memory grow with the page, not with its depth.

Defined results: a null, empty or tagless page is a page of that text; rows of null id and
repeated rows are pages like others; very long and deeply nested pages are read whole; of
equal ratios all count; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's elements by how they nest and what they show.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th", "tbody", "thead"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}, "p": {"article", "aside", "blockquote", "body", "button", "div", "figure", "footer", "form", "header", "li", "main", "nav", "section", "table", "td", "th"}}
BOILERPLATE = frozenset("script style noscript template title head nav footer aside select option button textarea input iframe object canvas svg math dialog menu noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu submenu sidebar aside footer"
    " masthead cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply replies respond disqus discussion related recommended"
    " newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager share sharing social toolbar widget widgets disclaimer copyright feedback guestbook talkback".split()
)
#: words that change nothing beside one of WORDS
BESIDE = frozenset("area bar block bottom box container footer form head header inner item items left link links list outer panel post posts right section side site slot stories text thread title top unit wrap wrapper".split())
#: an anchor's name on these says what their text is about
ANCHORED = frozenset("section article h1 h2 h3 h4 h5 h6 p dt li".split())
STRONG = frozenset("comment comments respond disqus sidebar cookie cookies newsletter".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article main".split())
CONTAINERS = CONTENT | frozenset("html body section div center td".split())
#: containers that a text beside passing paths must not lie in further in
APART = CONTAINERS - frozenset("html body td center".split())
#: headings of lists whose links belong to the article
SOURCES = re.compile(r"(?:sources?|references?|bibliography|citations?|(?:foot)?notes|works cited|literature|quellen|literatur|einzelnachweise|références|bibliographie|fuentes|referencias|bibliografía|notas)\W*", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？·\"'«»“”()¿¡-]")

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
LAMBDA, MARKED, LINKED = 0.5, 0.05, 1 / 3


@dataclass(slots=True)
class Node:
    """A block's text: the element around it, its path, its text and how much of that lies in links."""

    element: int
    path: int
    text: str
    linked: int


@dataclass(slots=True)
class Page:
    """Nodes in page order; per element (0 is the page itself) its tag, parent and mark; per path whether it holds a mark and ends in a heading."""

    nodes: list[Node] = field(default_factory=list)
    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    marks: list[bool] = field(default_factory=lambda: [False])
    marked_path: list[bool] = field(default_factory=lambda: [False])
    heading_path: list[bool] = field(default_factory=lambda: [False])


def _words_mark(value: str) -> bool:
    """Whether a class or id has a word that is boilerplate, alone or with words that change nothing."""
    for word in value.split():
        parts = [x for x in re.split("[-_]+", word) if x and not x.isdigit()]
        if not WORDS.isdisjoint(parts) and all(x in WORDS or x in BESIDE for x in parts):
            return True
    return False


def _read(tag: str, rest: str) -> tuple[bool, bool, str]:
    """(hidden or of a boilerplate role, marked by its words, first class) of an element's attributes."""
    if "=" not in rest and "hidden" not in rest:
        return False, False, ""
    hidden = marked = False
    first = ""
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "class":
            marked |= _words_mark(value)
            first = next(iter(value.split()), "")
        elif name == "id":
            marked |= value in STRONG if tag in ANCHORED else _words_mark(value)
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return hidden, marked, first


def parse(page: str) -> Page:
    """Text nodes outside boilerplate, in page order."""
    out = Page()
    stack: list[str] = []
    own: list[tuple[int, int]] = [(0, 0)]  # (element, path) of the blocks open, the page first
    held_by: list[int] = []  # per open element the number of blocks open with it
    open_tags: dict[str, int] = {}
    flags: list[bool] = []  # of inline elements that are marked
    drop: list[int] = []  # depths of the stack at which boilerplate began
    paths: dict[tuple[int, str], int] = {}
    held: list[str] = []
    linked = links = content = 0

    def close_block() -> None:
        nonlocal linked
        if held:
            text = SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                out.nodes.append(Node(*own[-1], text, min(linked, len(text))))
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links, content
        if any(t not in INLINE for t in stack[depth:]):
            close_block()
        for t, m in zip(stack[depth:], flags[depth:], strict=True):
            open_tags[t] -= 1
            links -= t == "a" or m
            content -= t in CONTENT
        del stack[depth:], flags[depth:]
        if len(held_by) > depth:
            del own[held_by[depth] :], held_by[depth:]
        while drop and drop[-1] >= depth:
            drop.pop()

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not drop:
            held.append(raw)
            if links:
                linked += len(raw)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if open_tags.get(tag):
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i] == tag))
            elif tag in ("p", "br") and not drop:
                close_block()
            continue
        rest = m[3] if m[2] else m[6]
        if tag in VOID:
            if tag in ("br", "hr") and not drop:
                close_block() if tag == "hr" else add(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        over = SIBLINGS.get(tag) or ({"p"} if tag in CLOSES_P else None)
        if over and any(map(open_tags.get, over)):
            scope = SCOPES["p" if over == {"p"} else tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in over:
                    pop_to(i)
                    if over == {"p"} or tag in ("li", "dt", "dd"):
                        break
                elif stack[i] in scope:
                    break
        inline = tag in INLINE
        if not inline and not drop:
            close_block()
        hidden, marked, first = _read(tag, rest)
        bad = hidden or tag in BOILERPLATE or (tag == "header" and not content)
        if tag in ("html", "body"):
            bad = marked = False
        stack.append(tag)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        flags.append(inline and marked and tag != "a")
        held_by.append(len(own))
        if not inline:
            above, path = own[-1]
            label = f"{tag}#{len(out.tags)}" if tag in CONTENT else f"{tag}.{first}" if first and tag in CONTAINERS else tag
            key = (path, label + "!" * marked)
            if key not in paths:
                paths[key] = len(out.marked_path)
                out.marked_path.append(marked or out.marked_path[path])
                out.heading_path.append(tag in HEADINGS)
            own.append((len(out.tags), paths[key]))
            out.tags.append(tag)
            out.parents.append(above)
            out.marks.append(marked)
        links += tag == "a" or flags[-1]
        content += tag in CONTENT
        if bad:
            drop.append(len(stack) - 1)
    pop_to(0)
    close_block()
    return out


def path_ratios(page: Page, nodes: list[Node]) -> dict[int, tuple[float, float]]:
    """Per path of the nodes its fused ratio, text and punctuation per node less what links hold, and the share that links hold."""
    sums: dict[int, list[float]] = {}
    for x in nodes:
        s = sums.setdefault(x.path, [0.0, 0.0, 0.0, 0.0])
        s[0] += len(x.text)
        s[1] += len(PUNCTUATION.findall(x.text))
        s[2] += x.linked
        s[3] += 1
    return {p: (chars / k * math.log1p(marks / k) * (1 - links / chars) * (MARKED if page.marked_path[p] else 1.0), links / chars) for p, (chars, marks, links, k) in sums.items()}


def held(page: Page, elements: Iterable[int]) -> list[int]:
    """Per element how many of the given ones lie in it, itself included."""
    out = [0] * len(page.tags)
    for e in elements:
        out[e] += 1
    # elements are numbered in page order, so children come after their parents
    for e in range(len(page.tags) - 1, 0, -1):
        out[page.parents[e]] += out[e]
    return out


def content_paths(page: Page, nodes: list[Node]) -> set[int]:
    """The paths whose ratio, smoothed over the nodes, passes the threshold.

    Smoothing lifts neither marked paths nor those of links, nor what lies in a container
    without any path that passes by itself.
    """
    ratios = path_ratios(page, nodes)
    raw = np.array([ratios[x.path][0] for x in nodes])
    smooth = raw
    if len(raw) > 2:
        kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
        smooth = np.convolve(np.pad(raw, 2, mode="edge"), kernel / kernel.sum(), mode="valid")
    least = min(LAMBDA * float(smooth.std()), float(raw.max()))
    strong = held(page, (x.element for x, r in zip(nodes, raw.tolist(), strict=True) if r >= least))
    around = [0] * len(page.tags)
    for e in range(1, len(page.tags)):
        around[e] = e if page.tags[e] in CONTAINERS else around[page.parents[e]]
    out = set()
    for x, r, s in zip(nodes, raw.tolist(), smooth.tolist(), strict=True):
        lifted = not page.marked_path[x.path] and ratios[x.path][1] < LINKED and strong[around[x.element]]
        if max(r, s if lifted else 0.0) >= least:
            out.add(x.path)
    return out


def outside_forms(page: Page) -> list[Node]:
    """The nodes that lie in no form, but for forms around containers that hold at least half of the page's text."""
    if "form" not in page.tags:
        return page.nodes
    chars, wraps = [0] * len(page.tags), [False] * len(page.tags)
    for x in page.nodes:
        chars[x.element] += len(x.text)
    for e in range(len(page.tags) - 1, 0, -1):
        up = page.parents[e]
        chars[up] += chars[e]
        wraps[up] |= wraps[e] or page.tags[e] in APART or page.tags[e] in HEADINGS
    gone = [False] * len(page.tags)
    for e in range(1, len(page.tags)):
        gone[e] = gone[page.parents[e]] or (page.tags[e] == "form" and not (wraps[e] and 2 * chars[e] >= chars[0]))
    return [x for x in page.nodes if not gone[x.element]]


def in_articles(page: Page, nodes: list[Node]) -> list[Node]:
    """The nodes within ``article`` and ``main`` if these hold at least half of the text outside links and marked paths, else all."""
    marked = [False] * len(page.tags)
    for e in range(1, len(page.tags)):
        marked[e] = page.tags[e] in CONTENT or marked[page.parents[e]]
    inside = [x for x in nodes if marked[x.element]]
    chars = lambda some: sum(len(x.text) - x.linked for x in some if not page.marked_path[x.path])
    return inside if inside and 2 * chars(inside) >= chars(nodes) else nodes


def content_nodes(page: Page, nodes: list[Node]) -> list[Node]:
    """Nodes of content paths, and within the deepest container around them what belongs to them."""
    if not nodes:
        return []
    paths = content_paths(page, nodes)
    there, all_there = held(page, (x.element for x in nodes if x.path in paths)), held(page, (x.element for x in nodes))
    # a block of a single text is no home, unless marked as content: its heading lies beside it
    home = next((e for e in range(len(page.tags) - 1, 0, -1) if there[e] == there[0] and (page.tags[e] in CONTENT or (page.tags[e] in CONTAINERS and all_there[e] > 1))), 0)
    # per element whether it lies in home, without a mark between, and without a container between
    within, clean, near = ([False] * len(page.tags) for _ in range(3))
    for e in range(len(page.tags)):
        up = page.parents[e]
        within[e] = e == home or (e > 0 and within[up])
        clean[e] = e == home or (e > 0 and clean[up] and not page.marks[e])
        near[e] = e == home or (e > 0 and near[up] and page.tags[e] not in APART)
    cited, listed = [], False
    for x in nodes:
        if page.heading_path[x.path]:
            listed = SOURCES.fullmatch(x.text) is not None
        cited.append(listed)
    out: list[Node] = []
    follows = False  # whether what comes next, headings aside, stays
    for x, source in zip(reversed(nodes), reversed(cited), strict=True):
        if page.heading_path[x.path] and (x.path not in paths or not PUNCTUATION.search(x.text)):
            # smoothing lifts headings of what goes, too
            stays = follows and within[x.element] and clean[x.element]
        elif x.path in paths:
            stays = follows = True
        else:
            stays = follows = clean[x.element] and near[x.element] and (source or x.linked < LINKED * len(x.text))
        if stays:
            out.append(x)
    return out[::-1]


def main_text(html: str | None) -> str:
    """The page's main text, its blocks joined by one space."""
    if not html:
        return ""
    page = parse(html)
    nodes = outside_forms(page)
    return " ".join(x.text for x in content_nodes(page, in_articles(page, nodes) if nodes else []))


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(pages[id_col].cast("long").alias("page_id"), pages[url].alias("url"), pages[html].alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
