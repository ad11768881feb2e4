"""Main text of pages written for the purpose, and of the supplied ones."""

from __future__ import annotations

import html
import os
import re

import numpy as np
import pytest

from accountlens.llm import html_text

SF_DIR = "/root/testdata/sf0.01"
LONG = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen."

CASES = {
    "": "",
    "just text that is long enough to be taken for the main text of a page without any element": (
        "just text that is long enough to be taken for the main text of a page without any element"),
    f"<article><h1>T</h1><p>{LONG}<p>Short.</article><footer><p>{LONG}</p></footer>": f"T\n{LONG}\nShort.",
    f"<nav><a href=x>Home</a></nav><main><p>a &amp; b&nbsp;&lt;c&#233;  d\n\te</p></main>": "a & b <cé d e",
    f"<article><p>{LONG}</p><aside>{LONG}</aside><form>{LONG}</form><p>x<br>y<script>z</script></p><!-- c --></article>": f"{LONG}\nx y",
    f"<article><p>in</p></article><section id='comments'><article><p>{LONG}</p></article></section>": "in",
    f"<article><p>in</p><div class='comment-list'><p>{LONG}</p></div></article><div class=ad>{LONG}</div>": "in",
    f"<article><p>in</p><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></article>": "in",
    f"<article><p>see <a>this</a> now</p><ul><li>one<li>two</ul></article>": "see this now\none\ntwo",
    f"<body class='has-sidebar'><div id=menu><a>x</a></div><div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>": (
        f"Head\n{LONG}\nShort.\n{LONG}"),
    f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article": f"Title\n{LONG}",
    f"<article><p>a</p><style>p{{}}</style><textarea>t</textarea><p hidden>h</p><svg><text>s</text></svg></article>": "a",
    "<article><p>cut <b>off": "cut off",
    f"<article><p>1 < 2 and 3 > 2</p></article>": "1 < 2 and 3 > 2",
    f"<script>var t='<article>{LONG}</article>'</script>": "",
    f"<div class='cookie-notice'>{LONG}</div><div role=alert>{LONG}</div>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_pages(page):
    assert html_text.main_text(page) == CASES[page]


def test_tree_learns_its_table():
    table = html_text.LABELLED
    assert (html_text.decide(table[:, :-1]) == table[:, -1]).all()
    assert html_text.decide(np.zeros((0, table.shape[1] - 1))).tolist() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")
def test_supplied_pages_give_their_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = html_text.query(spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body.replace("<br>", " ")))
        assert r.text == "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)
        assert r.n_chars == len(r.text)


def test_null_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, None, "<article>" + "x " * 200_000)],
                                  "page_id long, url string, html string")
    rows = html_text.extract(pages, ["page_id", "url"]).collect()
    assert sorted((r.n_chars for r in rows)) == [0, 0, 399_999]
    assert html_text.extract(pages.filter("page_id > 9"), ["page_id"]).collect() == []
