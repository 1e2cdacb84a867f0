import re
from html import unescape

import numpy as np
import pytest

from barflow.llm.html_extract import FEATURES, LABELLED, blocks, extract, grow, is_content, main_text
from barflow.llm.queries import LLM_QUERIES

TREE = grow(LABELLED)
LONG = "This paragraph has quite a number of words, so that it looks like running text and not like a menu. "

PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p>";</script></head><body class="has-sidebar">
<header><h2>Site</h2><p>{LONG}</p></header><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
<div class="cookie-notice"><p>{LONG}</p></div><article><header><h1>Title &amp; more</h1></header><p>First   &lt;p&gt;\n&nbsp;line {LONG}</p>
<p>Short.<p><b>Bold.<br>Next</b></p><form><label>Mail</label><input></form><div class="ad">{LONG}</div><ul><li>One item</li></ul>
<table><tr><td>a</td><td>b</td></tr></table></article><aside><p>{LONG}</p></aside><section id="comments"><article><p>{LONG}</p></article></section>
<!-- <p>{LONG}</p> --><footer>&copy; x</footer></body></html>"""


def test_table_and_tree():
    assert LABELLED.shape[1] == len(FEATURES) + 1 and len(LABELLED) <= 200
    assert all(is_content(TREE, tuple(r[:-1])) == bool(r[-1]) for r in LABELLED)
    assert grow(np.array([[1.0, 1.0]])) == 1 and grow(np.array([[1.0, 0.0], [1.0, 1.0], [1.0, 0.0]])) == 0


def test_article_alone_is_left():
    text = main_text(PAGE, TREE)
    assert text == f"Title & more\nFirst <p> line {LONG.strip()}\nShort.\nBold.\nNext\nOne item\na\nb"


def test_page_without_article():
    page = f"<div id=menu><a href=x>Home</a></div><div><h2>Head line</h2><p>{LONG}<p>{LONG}</div><div class=footer>{LONG}</div>"
    assert main_text(page, TREE) == "\n".join(["Head line", LONG.strip(), LONG.strip()])


@pytest.mark.parametrize(
    "html", [None, "", "<", "<p", "a < b", "<p class='x", "</div></div>", "<script>never closed", "<!-- open", "<a href=\"x>y", "&am", "<![CDATA[x < y]]>"]
)
def test_odd_pages_do_not_fail(html):
    assert isinstance(main_text(html, TREE), str)


def test_broken_markup_stays_linear():
    for part in ("<p", "<a href='", "<div ", "</p", "<!--", "&amp", "<b><p>x"):
        assert isinstance(main_text(f"<article>{part * 30_000}", TREE), str)


def test_link_density_and_neighbours():
    found = blocks("<p>one <a>two three</a> four</p><p><a>x</a></p>")
    assert [(b.text, b.words, b.linked) for b in found] == [("one two three four", 4, 2), ("x", 1, 1)]


def test_hidden_and_unclosed_parts():
    page = f"<main><p>{LONG}</p><p hidden>{LONG}</p><div style='display: none'>{LONG}</div><p class=comment>{LONG}<p>End of it all.</main>"
    assert main_text(page, TREE) == f"{LONG.strip()}\nEnd of it all."


def test_frame(spark):
    df = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "<article>" + "<p>a b</p>" * 20_000, "x")], "page_id int, html string, Text string")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert extract(df).columns == ["page_id", "text"]
    assert got[2] == got[3] == "" and got[1].startswith("Title") and got[4].count("\n") == 19_999
    assert extract(df.limit(0)).count() == 0


def test_query_against_the_pages_own_articles(spark, small):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    found = LLM_QUERIES["op2_html_extract"](spark, small).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        lines = re.split(r"\n", re.sub(r"</?b>", "", re.sub(r"<br>|</?p>|</?h1>", "\n", inner)))
        assert r["text"] == "\n".join(x for x in (" ".join(unescape(t).split()) for t in lines) if x)
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    "page",
    ['<article class="post category-social">{}</article>', '<div class="layout-with-sidebar"><article>{}</article></div>',
     "<form action=/x><div><article>{}</article></div></form>", '<article data-hidden="false">{}</article>', '<article title="not hidden here">{}</article>',
     '<div class="sidebar-left"><main>{}</main></div>', '<article class="social">{}</article>'],
)
def test_names_that_do_not_make_the_article_boilerplate(page):
    paragraphs = "".join(f"<p>{LONG}</p>" for _ in range(3))
    assert main_text(f"<html><body>{page.format(paragraphs)}</body></html>", TREE) == "\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize(
    "part",
    ['<div class="site-footer">{}</div>', '<div class="share-bar">{}</div>', '<form class="x">{}</form>', "<aside><article>{}</article></aside>",
     '<section id="comments"><article>{}</article></section>', '<div hidden><article>{}</article></div>', '<article class="comment">{}</article>'],
)
def test_parts_that_stay_boilerplate(part):
    paragraphs = "".join(f"<p>{LONG}</p>" for _ in range(3))
    for main in (f"<article>{paragraphs}</article>", f"<div>{paragraphs}</div>"):
        assert main_text(f"<html><body>{main}{part.format(f'<p>{LONG}</p>')}</body></html>", TREE) == "\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize("page", ['<form id="aspnetForm"><div>{}</div></form>', '<div data-grid="top">{}</div>'])
def test_pages_without_article_are_left_to_the_tree(page):
    paragraphs = "".join(f"<p>{LONG * n}</p>" for n in (3, 2, 4))
    text = main_text(f"<body>{page.format(paragraphs)}</body>", TREE)
    assert text and text == main_text(f"<body><div>{paragraphs}</div></body>", TREE)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def _text(n, start=0):
    return " ".join(WORDS[(start + i) % 12] for i in range(n))


@pytest.mark.parametrize("name", ["share-price", "warning-signs", "related-work", "searchResults", "top-story", "menu-of-the-day", "social-history", "comment-free"])
@pytest.mark.parametrize("how", ["class", "id"])
def test_names_that_only_begin_like_boilerplate_stay(name, how):
    page = f"<article><p>{_text(50)}</p><section {how}='{name}'><p>{_text(45, 3)}</p></section><p>{_text(40, 5)}</p></article>"
    assert main_text(page, grow(LABELLED)).count("\n") == 2
    body = f"<body><p>{_text(50)}</p><div {how}='{name}'><p>{_text(45, 3)}</p></div><p>{_text(40, 5)}</p></body>"
    assert main_text(body, grow(LABELLED)).count("\n") == 2


@pytest.mark.parametrize("name", ["user-comments", "reader-comments", "readerComments", "comments-list", "site-cookie-notice", "main-nav", "ad", "ad-slot", "related-posts", "share-buttons"])
def test_comments_notices_and_the_like_go(name):
    tree = grow(LABELLED)
    inside = f"<article><p>{_text(50)}</p><div class='{name}'><p>{_text(12, 3)}</p></div><p>{_text(40, 5)}</p></article>"
    beside = f"<body><div class='{name}'><p>{_text(12, 3)}</p></div><div><p>{_text(50)}</p><p>{_text(40, 5)}</p></div></body>"
    for page in (inside, beside):
        assert main_text(page, tree) == f"{_text(50)}\n{_text(40, 5)}"


def test_pages_without_an_article_element():
    tree = grow(LABELLED)
    short = "<h1>Title</h1><p>One short line here.</p><p>And one more of them.</p><p>The end of it.</p>"
    assert main_text(short, tree) == "Title\nOne short line here.\nAnd one more of them.\nThe end of it."
    divs = f"<div><div>{_text(60)}</div><div>Two words</div><div>{_text(30, 2)}</div></div>"
    assert main_text(divs, tree) == f"{_text(60)}\nTwo words\n{_text(30, 2)}"
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/a>About us</a></li></ul>"
    assert main_text(menu + short + menu, tree) == main_text(short, tree)


def test_a_name_that_marks_the_whole_page_speaks_of_the_page():
    page = f"<div class='layout-with-sidebar'><h1>Title</h1><p>{_text(30)}</p><p>{_text(40)}</p><div class='sidebar'><p>{_text(9)}</p></div></div>"
    assert main_text(page, grow(LABELLED)) == f"Title\n{_text(30)}\n{_text(40)}"


def test_linked_lines_of_an_article_stay():
    sources = "".join(f"<li><a href=/{i}>{_text(6, i)}</a></li>" for i in range(4))
    page = f"<article><p>{_text(50)}</p><p><a href=/x>{_text(14, 1)}</a></p><p>{_text(30, 2)}</p><h2>Sources</h2><ol>{sources}</ol></article>"
    assert main_text(page, grow(LABELLED)).split("\n") == [_text(50), _text(14, 1), _text(30, 2), "Sources", *[_text(6, i) for i in range(4)]]
