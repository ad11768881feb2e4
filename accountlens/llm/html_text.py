"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once, tag by tag, into a flat list of text blocks; nothing of a tree is kept but the open elements. A block
has a word count, the share of its words in links, whether it is a heading, and whether one of its open elements is
the article or something that never is (menu, footer, form, advert, notice, reader comments). The word counts and
link shares of its neighbours complete the features. A decision tree grown in numpy on a small labelled table
(``labelled_table``: typical blocks) says which blocks are main text. The tree is a few nodes, sent with the code; one pass reads whole pages.

Defined cases: null and empty pages give an empty text; tags cut off at the end of a page are dropped; elements that are
never closed end with their parent; a page without an element for the article is judged by word counts and links.
Repeated rows are extracted each; null ids and urls are passed on.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from accountlens.llm.common import map_texts, read_table

#: Elements by what they mean for text.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody
td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
SILENT = frozenset("head select button object audio video canvas datalist option label".split())
UNWANTED = frozenset("nav aside footer form menu dialog".split())
MAIN = frozenset("article main".split())
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}}
#: An element that closes itself goes no further up than these.
FENCES = frozenset("ul ol dl table div section article main body td th nav aside footer header form blockquote menu".split())

#: Parts of a class, id or role that mark what is no article, and what is one.
HINTS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies
consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer share
sharing social related recommended newsletter subscribe subscription signup login search widget toolbar pagination pager
copyright comment comments commentlist disqus respond complementary contentinfo outbrain taboola""".split())
COMMENTS = frozenset("comment comments commentlist disqus respond ad ads advert advertisement sponsored promo related".split())
SITE_HEAD = frozenset("header masthead topbar".split())
MAIN_HINTS = frozenset("article articlebody main".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                  r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|</[^>]*(?:>|$)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z]+")

FEATURES = ["words", "links", "prev_words", "prev_links", "next_words", "next_links", "unwanted", "in_main", "page_has_main",
            "heading"]
#: The examples: words and link share of a block and of its neighbours (few and many words, plain and linked), crossed.
_WORDS = (1, 5, 12, 15, 60)
_LINKS = (0.0, 0.5, 0.8, 1.0)
_NEIGHBOURS = ((0, 0.0), (3, 1.0), (12, 0.0), (15, 0.0), (60, 0.2), (30, 1.0))
_FLAGS = ((1, 0, 0), (1, 1, 1), (1, 0, 1), (0, 0, 1), (0, 1, 1), (0, 0, 0))


def _label(words, links, before, after, unwanted, in_main, has_main, heading) -> bool:
    """What a reader calls main text among the examples."""
    if unwanted or has_main and not in_main:
        return False
    plain = links <= 0.5
    if in_main:
        # In the article all but lists of links.
        return bool(heading or plain or (before[1] <= 0.5 and after[1] <= 0.5) or words > 12)
    # Without an article: long plain text, and what stands in its midst or heads it.
    long_before, long_after = (n[0] > 12 and n[1] <= 0.5 for n in (before, after))
    return bool(plain and (words > 12 or long_after and (long_before or heading)))


def labelled_table() -> np.ndarray:
    """The small labelled table: a row of features for each example, then 1 for main text."""
    return np.array([(w, share, *before, *after, *flags, heading, _label(w, share, before, after, *flags, heading))
                     for w in _WORDS for share in _LINKS for before in _NEIGHBOURS for after in _NEIGHBOURS
                     for flags in _FLAGS for heading in (0, 1)], float)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10) -> list[tuple[int, float, int, int, int]]:
    """A decision tree by the Gini index: nodes (feature or -1, threshold, left, right, class)."""
    nodes: list[tuple[int, float, int, int, int]] = []

    def impurity(labels: np.ndarray) -> float:
        p = labels.mean() if len(labels) else 0.0
        return len(labels) * 2 * p * (1 - p)

    def split(rows: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, at, at, int(2 * y[rows].sum() >= len(rows))))
        best, whole = (1e-9, -1, 0.0), impurity(y[rows])
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for cut in (values[1:] + values[:-1]) / 2:
                goes = x[rows, f] <= cut
                gain = whole - impurity(y[rows][goes]) - impurity(y[rows][~goes])
                if gain > best[0] + 1e-9:
                    best = (gain, f, float(cut))
        if level < depth and best[1] >= 0:
            goes = x[rows, best[1]] <= best[2]
            left, right = split(rows[goes], level + 1), split(rows[~goes], level + 1)
            nodes[at] = (best[1], best[2], left, right, 0)
        return at

    split(np.arange(len(x)), 0)
    return nodes


LABELLED = labelled_table()
TREE = grow(LABELLED[:, :-1], LABELLED[:, -1])


def decide(x: np.ndarray, tree: list[tuple[int, float, int, int, int]] = TREE) -> np.ndarray:
    """Class of each row of features."""
    feature, threshold, left, right, label = (np.array(c) for c in zip(*tree, strict=True))
    at = np.zeros(len(x), int)
    rows = np.arange(len(x))
    while len(x) and (feature[at] >= 0).any():
        inner = feature[at] >= 0
        goes = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
        at = np.where(inner, np.where(goes, left[at], right[at]), at)
    return label[at].astype(bool)


def _kind(name: str, attrs: str, in_main: bool) -> str:
    """What an opened element is: unwanted, main, or nothing of note."""
    found = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return "unwanted"
    parts = set(_PART.findall(" ".join(found.get(k, "") for k in ("class", "id", "role"))))
    if name in MAIN or found.get("role") in MAIN:
        return "unwanted" if parts & COMMENTS else "main"
    if name in UNWANTED or name not in ("html", "body") and parts & HINTS:
        return "unwanted"
    if not in_main and (name == "header" or name not in ("html", "body") and parts & SITE_HEAD):
        return "unwanted"
    return "main" if name in BLOCK and name not in ("html", "body") and parts & MAIN_HINTS else ""


def blocks(page: str) -> Iterator[tuple[str, int, int, bool, bool, bool]]:
    """Text, words, words in links, unwanted, in the article, heading: for each block with text, in page order."""
    opened: list[tuple[str, str]] = []
    parts: list[tuple[str, bool]] = []
    at = 0

    def flush() -> Iterator[tuple[str, int, int, bool, bool, bool]]:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                kinds = {k for _, k in opened}
                linked = sum(len(t.split()) for t, link in parts if link)
                yield (text, text.count(" ") + 1, linked, "unwanted" in kinds, "main" in kinds,
                       any(len(n) == 2 and n[0] == "h" and n[1] in "123456" for n, _ in opened))
            parts.clear()

    def say(raw: str) -> None:
        if raw and not any(n in SILENT for n, _ in opened):
            parts.append((raw, any(n == "a" for n, _ in opened)))

    while at < len(page):
        m = _TAG.search(page, at)
        say(html.unescape(page[at:m.start() if m else len(page)]))
        if not m:
            break
        at = m.end()
        if m["cdata"] is not None:
            say(m["cdata"])
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            if any(n == name for n, _ in opened):
                if name in BLOCK:
                    yield from flush()
                while opened.pop()[0] != name:
                    pass
            elif name in BLOCK:
                yield from flush()
            continue
        if name in BLOCK:
            yield from flush()
        elif name == "br":
            say(" ")
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = stop.start() if stop else len(page)
            if stop:
                closed = page.find(">", at)
                at = closed + 1 if closed >= 0 else len(page)
            continue
        if name in VOID:
            continue
        if name == "body":
            # A head that was never closed ends here.
            opened[:] = [o for o in opened if o[0] != "head"]
        for k in range(len(opened) - 1, -1, -1):
            if opened[k][0] in CLOSES_ITSELF.get(name, ()):
                del opened[k:]
                break
            if opened[k][0] in FENCES:
                break
        if not m["attrs"].endswith("/") or name in BLOCK or name == "a":
            opened.append((name, _kind(name, m["attrs"], any(k == "main" for _, k in opened))))
    yield from flush()


def main_text(page: str) -> str:
    """The blocks that the tree takes for main text, joined by line ends."""
    found = list(blocks(page))
    if not found:
        return ""
    words, linked = (np.array([b[k] for b in found], float) for k in (1, 2))
    links = np.minimum(linked / words, 1)
    none = np.zeros(1)
    flags = np.array([b[3:] for b in found], float)
    has_main = np.full(len(found), float(((flags[:, 1] > 0) & (flags[:, 0] == 0)).any()))
    x = np.column_stack([words, links, np.concatenate([none, words[:-1]]), np.concatenate([none, links[:-1]]),
                         np.concatenate([words[1:], none]), np.concatenate([links[1:], none]),
                         flags[:, 0], flags[:, 1], has_main, flags[:, 2]])
    return "\n".join(b[0] for b, keep in zip(found, decide(x), strict=True) if keep)


def extract(pages: DataFrame, carry: list[str], column: str = "html") -> DataFrame:
    """``carry`` columns, ``text`` and ``n_chars`` for each row of ``pages``."""
    def work(bodies):
        texts = [main_text(b.decode("utf-8", "replace")) for b in bodies]
        return texts, [len(t) for t in texts]

    return map_texts(pages, carry, work, "text string, n_chars long", text=column)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"), ["page_id", "url"])
