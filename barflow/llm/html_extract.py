"""Main text of HTML pages from flat text blocks.

A page is cut into text blocks at block-level markup. A block is described by the word counts and link densities of
itself and its two neighbours and by where it stands; a decision tree, trained on the small labelled table below, tells
content from boilerplate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import column

# Element names of HTML, and words by which page parts are named.
HIDDEN = set("script style noscript template head title svg math iframe object canvas audio video select textarea button".split())
INLINE = set(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter nobr output picture
    progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr""".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = set("p".split())
BOILERPLATE = set("nav footer aside form menu dialog fieldset".split())
CONTENT = set("article main".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    """ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs byline comment comments
    commentlist consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar
    navigation newsletter notice notices notification notifications pager pagination paywall popup promo promos promotion recommended
    related respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe tagcloud toolbar
    widget widgets""".split()
)
#: Names of several parts that say so together.
PHRASES = set(
    """related-posts related-articles related-stories related-links related-content recent-posts popular-posts latest-posts
    share-buttons share-links share-icons social-links social-icons social-buttons social-media read-more more-stories
    skip-link skip-to-content sign-up log-in ad-label""".split()
)
#: Names that say so only outside the article.
OUTER_NAMES = set("header".split())
#: Last parts of a name that only say what kind of box it is ("comments-list").
BOXES = set(
    """area bar block body box button buttons column container content form group heading holder icon inner item left list
    outer panel popup region right row section slot title top bottom unit widget wrap wrapper""".split()
)

_MARKUP = re.compile(
    r"""<!--(?:.*?-->|.*)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*(?:>|$)
    |<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>
    |<(?P<end2>/)?(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|$)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]++))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: What an element's marks are worth: none, one that an article in it outweighs, one that nothing does.
_PLAIN, _SOFT, _HARD = 0, 1, 2


@dataclass
class Block:
    """A run of text between block-level marks."""

    text: str
    words: int
    linked: int
    marked: bool
    inside: bool
    heading: bool

    @property
    def link_density(self) -> float:
        return self.linked / self.words


@dataclass
class _Element:
    """An open element that may hold text, the place of the one it stands in, and what is known of it."""

    name: str
    parent: int
    mark: int
    content: bool
    within: bool
    form: bool
    named: bool


def _attributes(attrs: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        found.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    return found


def _named(found: dict[str, str], inside: bool) -> int:
    """Whether an element's attributes call it a part other than the article: a mark.

    A name's last part says what the element is ("user-comments", but "share-price" is a price), box words behind it aside.
    """
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return _HARD
    if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return _HARD
    mark = _SOFT if found.get("role", "").lower() in ROLES else _PLAIN
    for token in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in _PART.findall(token)]
        while len(parts) > 1 and parts[-1] in BOXES and "-".join(parts[-2:]) not in PHRASES:
            parts.pop()
        if not parts:
            continue
        last = parts[-1]
        if last in ("comment", "comments", "commentlist", "disqus"):
            return _HARD
        if last in NAMES or "-".join(parts[-2:]) in PHRASES or (not inside and last in OUTER_NAMES):
            mark = _SOFT
    return mark


def _settle(elements: list[_Element], homes: list[int], found: list[Block]) -> None:
    """Tell the blocks whether they stand in marked elements and in the article, once the whole page is known.

    A form that wraps half of the page's unmarked words or more is not marked as a form, and a name that would mark two thirds
    of the page's words speaks of the page ("has-sidebar"). Where all articles stand in
    marked elements, or are marked themselves, and the least marked of them hold as many words as all unmarked blocks, their
    marks are void, other than those of hidden elements and comments.
    """
    total = [0] * (len(elements) + 1)  # words under an element that no mark but a form's covers; the last is the page

    def marks(void: set[int], forms: bool = True) -> list[int]:
        out: list[int] = []
        for k, e in enumerate(elements):
            own = e.mark != _PLAIN or (forms and e.form)
            out.append((out[e.parent] if e.parent >= 0 else 0) + (own and k not in void))
        return out

    void: set[int] = set()
    if any(e.form for e in elements):
        bare = marks(void, forms=False)
        for b, home in zip(found, homes, strict=True):
            if home < 0 or not bare[home]:
                total[home] += b.words  # home -1: the page
        for k in range(len(elements) - 1, -1, -1):
            total[elements[k].parent] += total[k]
        void = {k for k, e in enumerate(elements) if e.form and e.mark == _PLAIN and 2 * total[k] >= total[-1] > 0}

    words_of = [0] * (len(elements) + 1)
    for b, home in zip(found, homes, strict=True):
        words_of[home] += b.words
    for k in range(len(elements) - 1, -1, -1):
        words_of[elements[k].parent] += words_of[k]
    void |= {k for k, e in enumerate(elements) if e.named and e.mark == _SOFT and 3 * words_of[k] >= 2 * words_of[-1] > 0}

    deep = marks(void)
    holds = [-1] * len(elements)  # the least marked article, or none, that an element stands in
    for k, e in enumerate(elements):
        up = holds[e.parent] if e.parent >= 0 else -1
        holds[k] = up if up >= 0 or not e.content else k
    open_words = sum(b.words for b, home in zip(found, homes, strict=True) if home < 0 or not deep[home])
    words: dict[int, int] = {}
    for b, home in zip(found, homes, strict=True):
        if home >= 0 and holds[home] >= 0:
            words[holds[home]] = words.get(holds[home], 0) + b.words
    if words and all(deep[k] for k in words):
        least = min(deep[k] for k in words)
        nearest = [k for k in words if deep[k] == least]
        above = set()
        for k in nearest:
            while k >= 0 and k not in above:
                above.add(k)
                k = elements[k].parent
        if sum(words[k] for k in nearest) >= open_words and all(elements[k].mark != _HARD for k in above):
            void |= above
            deep = marks(void)

    inside: list[bool] = []
    for k, e in enumerate(elements):
        inside.append((e.parent >= 0 and inside[e.parent]) or (e.content and not deep[k]))
    for b, home in zip(found, homes, strict=True):
        b.marked, b.inside = home >= 0 and deep[home] > 0, home >= 0 and inside[home]


def blocks(html: str | None) -> list[Block]:
    """Flat text blocks of a page in order. Character references are decoded once; hidden elements have no text."""
    html = html or ""
    out: list[Block] = []
    elements: list[_Element] = []
    stack: list[int] = []  # places of open elements
    homes: list[int] = []  # of each block
    text: list[str] = []
    linked: list[str] = []
    links, heading, at = 0, 0, 0

    def end_block():
        whole = " ".join(unescape("".join(text)).split())
        if whole:
            anchors = len(unescape(" ".join(linked)).split())
            words = len(whole.split(" "))
            out.append(Block(whole, words, min(anchors, words), False, False, heading > 0))
            homes.append(stack[-1] if stack else -1)
        text.clear()
        linked.clear()

    def add(part: str):
        text.append(part)
        if links:
            linked.append(part)

    while at < len(html):
        m = _MARKUP.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        if m["data"] is not None:
            add(m["data"].replace("&", "&amp;"))
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if name in HIDDEN and not closing:
            if name not in ("head",) and not attrs.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            continue
        if name == "a":
            links = 0 if closing else 1
        if name not in INLINE:
            end_block()
            if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                heading = 0 if closing else 1
            elif not closing:
                heading = 0
            if name != "br":
                links = 0
        if name in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if elements[stack[k]].name == name:
                    if name in INLINE:
                        end_block()
                    del stack[k:]
                    break
            continue
        if name not in INLINE and stack and elements[stack[-1]].name in CLOSED_BY_BLOCK:
            stack.pop()
        parent = stack[-1] if stack else -1
        within = parent >= 0 and elements[parent].within
        has = _attributes(attrs) if attrs and name not in ("html", "body") else {}
        named = _named(has, within) if has and name != "main" else _PLAIN
        if name in INLINE:
            if not named:
                continue
            end_block()
        form, by_name = name == "form", named == _SOFT
        if name in BOILERPLATE and not form:
            by_name = False
        if not named and not form and (name in BOILERPLATE or (name == "header" and not within)):
            named = _SOFT
        content = name in CONTENT or (name != "a" and has.get("role", "").lower() in CONTENT)
        stack.append(len(elements))
        elements.append(_Element(name, parent, named, content, within or content, form, by_name))
    end_block()
    _settle(elements, homes, out)
    return out


#: Columns of the labelled table and features of the tree. place: 1 inside an article or main element, -1 outside while
#: the page has one, 0 if it has none. Densities are link words by words; a missing neighbour has 0 words and density 0.
FEATURES = ("place", "marked", "heading", "words_before", "links_before", "words", "links", "words_after", "links_after")

# The labelled table. Blocks of pages made up by hand, with 1 for content and 0 for boilerplate.
LABELLED = np.array(
    [
        # pages with an article element: its headings, paragraphs, short lines, single words
        (1, 0, 1, 12, 0.1, 8, 0.0, 60, 0.0, 1), (1, 0, 1, 0, 0.0, 3, 0.0, 9, 0.0, 1), (1, 0, 1, 9, 0.9, 11, 0.0, 4, 0.0, 1),
        (1, 0, 0, 8, 0.0, 60, 0.0, 45, 0.1, 1), (1, 0, 0, 60, 0.0, 45, 0.1, 80, 0.0, 1), (1, 0, 0, 45, 0.0, 1, 0.0, 70, 0.0, 1),
        (1, 0, 0, 3, 0.0, 4, 0.0, 5, 0.0, 1), (1, 0, 0, 70, 0.0, 12, 0.0, 9, 1.0, 1), (1, 0, 0, 1, 0.0, 900, 0.0, 2, 0.0, 1),
        (1, 0, 0, 30, 0.2, 25, 0.4, 30, 0.3, 1), (1, 0, 0, 90, 0.0, 33, 0.6, 12, 0.0, 1), (1, 0, 0, 15, 0.0, 2, 0.0, 10, 0.5, 1),
        (1, 0, 0, 6, 0.0, 7, 0.3, 8, 0.0, 1), (1, 0, 0, 40, 0.0, 6, 0.5, 50, 0.0, 1), (1, 0, 1, 80, 0.0, 2, 0.0, 90, 0.0, 1),
        (1, 0, 0, 2, 0.0, 3, 0.0, 2, 0.0, 1), (1, 0, 0, 9, 0.0, 200, 0.0, 0, 0.0, 1), (1, 0, 0, 300, 0.0, 5, 0.0, 16, 0.1, 1),
        (1, 0, 0, 0, 0.0, 90, 0.0, 6, 1.0, 1), (1, 0, 0, 4, 0.0, 400, 0.0, 1, 0.0, 1), (1, 0, 0, 1, 1.0, 8, 0.1, 1, 1.0, 1),
        (1, 0, 0, 0, 0.0, 2, 0.0, 0, 0.0, 1), (1, 0, 0, 14, 0.0, 30, 0.2, 8, 0.0, 1),
        (1, 0, 0, 70, 0.0, 4, 0.0, 0, 0.0, 1), (1, 0, 0, 80, 0.0, 12, 0.0, 3, 0.0, 1),
        (1, 0, 0, 5, 1.0, 3, 0.0, 9, 0.0, 1), (1, 0, 0, 3, 0.9, 6, 0.2, 4, 1.0, 1), (1, 0, 1, 4, 1.0, 2, 0.0, 3, 0.0, 1),
        (1, 0, 0, 20, 0.6, 5, 0.5, 20, 0.0, 1), (1, 0, 0, 60, 0.0, 2, 0.0, 1, 1.0, 1), (1, 0, 0, 45, 0.0, 9, 0.3, 0, 0.0, 1),
        # its lists of sources, paragraphs that are links
        (1, 0, 0, 8, 1.0, 9, 1.0, 7, 1.0, 1), (1, 0, 0, 60, 0.0, 12, 1.0, 50, 0.0, 1), (1, 0, 0, 2, 0.0, 5, 1.0, 6, 1.0, 1),
        (1, 0, 0, 6, 1.0, 5, 1.0, 70, 0.0, 1), (1, 0, 0, 30, 0.0, 4, 1.0, 40, 0.0, 1), (1, 0, 0, 70, 0.0, 5, 1.0, 4, 1.0, 1),
        (1, 0, 0, 4, 1.0, 7, 1.0, 3, 0.0, 1), (1, 0, 0, 5, 1.0, 5, 1.0, 5, 1.0, 1), (1, 0, 0, 6, 1.0, 40, 1.0, 6, 1.0, 1),
        (1, 0, 0, 40, 0.0, 2, 1.0, 35, 0.0, 1), (1, 0, 0, 20, 0.0, 3, 1.0, 0, 0.0, 1), (1, 0, 1, 5, 0.0, 2, 1.0, 30, 0.0, 1),
        (1, 0, 0, 14, 1.0, 30, 0.0, 1, 0.0, 1), (1, 0, 0, 12, 1.0, 18, 0.0, 8, 1.0, 1), (1, 0, 1, 40, 0.0, 1, 0.0, 6, 1.0, 1),
        (1, 0, 0, 1, 0.0, 6, 1.0, 6, 1.0, 1), (1, 0, 0, 6, 1.0, 6, 1.0, 0, 0.0, 1), (1, 0, 0, 6, 1.0, 6, 1.0, 9, 0.0, 1),
        (1, 0, 0, 20, 0.2, 4, 0.0, 9, 1.0, 1), (1, 0, 1, 20, 0.0, 4, 0.0, 30, 1.0, 1), (1, 0, 0, 20, 0.0, 3, 0.1, 9, 1.0, 1),
        (1, 0, 0, 5, 0.0, 2, 0.0, 5, 1.0, 1), (1, 0, 0, 60, 0.0, 4, 0.1, 20, 1.0, 1),
        # in it: tags, adverts, share bars, forms, comments
        (1, 0, 0, 2, 1.0, 2, 1.0, 3, 1.0, 0), (1, 0, 0, 1, 1.0, 1, 1.0, 2, 1.0, 0), (1, 0, 0, 3, 1.0, 3, 1.0, 2, 1.0, 0),
        (1, 1, 0, 50, 0.0, 12, 0.0, 60, 0.0, 0), (1, 1, 0, 50, 0.0, 6, 0.8, 0, 0.0, 0), (1, 1, 0, 20, 0.0, 45, 0.0, 38, 0.0, 0),
        (1, 1, 1, 20, 0.0, 2, 0.0, 38, 0.0, 0), (1, 1, 0, 45, 0.0, 120, 0.0, 30, 0.1, 0), (1, 1, 0, 3, 0.0, 1, 0.0, 2, 1.0, 0),
        # around it
        (-1, 1, 0, 0, 0.0, 2, 1.0, 1, 1.0, 0), (-1, 1, 0, 1, 1.0, 1, 1.0, 14, 0.0, 0), (-1, 1, 0, 2, 1.0, 14, 0.0, 9, 0.0, 0),
        (-1, 1, 0, 80, 0.0, 16, 0.1, 0, 0.0, 0), (-1, 0, 0, 1, 1.0, 14, 0.0, 9, 0.0, 0), (-1, 0, 0, 60, 0.0, 40, 0.0, 0, 0.0, 0),
        (-1, 0, 1, 60, 0.0, 3, 0.0, 5, 1.0, 0), (-1, 0, 0, 3, 0.0, 75, 0.0, 2, 0.5, 0), (-1, 1, 0, 50, 0.0, 200, 0.0, 30, 0.0, 0),
        (-1, 1, 1, 4, 0.0, 5, 0.0, 6, 0.0, 0), (-1, 0, 0, 0, 0.0, 6, 0.0, 4, 1.0, 0), (-1, 0, 0, 12, 0.4, 25, 0.3, 7, 0.9, 0),
        (-1, 0, 0, 9, 0.0, 120, 0.0, 80, 0.0, 0), (-1, 0, 0, 30, 0.0, 18, 0.0, 45, 0.0, 0), (-1, 0, 0, 2, 1.0, 300, 0.0, 6, 0.0, 0),
        (-1, 0, 0, 100, 0.0, 8, 0.0, 90, 0.0, 0), (-1, 0, 1, 100, 0.0, 8, 0.0, 90, 0.0, 0), (-1, 0, 0, 6, 0.0, 5, 0.0, 200, 0.0, 0),
        (-1, 0, 0, 70, 0.1, 22, 0.0, 12, 0.0, 0), (-1, 0, 0, 0, 0.0, 11, 0.0, 33, 0.0, 0), (-1, 0, 0, 15, 0.0, 60, 0.1, 0, 0.0, 0),
        # pages without one: paragraphs and headings next to them
        (0, 0, 0, 12, 0.0, 60, 0.0, 45, 0.0, 1), (0, 0, 0, 60, 0.0, 45, 0.1, 30, 0.0, 1), (0, 0, 0, 45, 0.0, 30, 0.2, 25, 0.9, 1),
        (0, 0, 0, 3, 1.0, 80, 0.0, 4, 1.0, 1), (0, 0, 0, 40, 0.0, 22, 0.3, 60, 0.0, 1), (0, 0, 1, 4, 1.0, 9, 0.0, 60, 0.0, 1),
        (0, 0, 1, 60, 0.0, 4, 0.0, 55, 0.0, 1), (0, 0, 0, 60, 0.0, 8, 0.0, 50, 0.0, 1), (0, 0, 0, 35, 0.0, 12, 0.1, 28, 0.0, 1),
        (0, 0, 0, 80, 0.0, 3, 0.0, 90, 0.0, 1), (0, 0, 0, 0, 0.0, 120, 0.0, 0, 0.0, 1), (0, 0, 0, 20, 0.1, 19, 0.0, 18, 0.0, 1),
        (0, 0, 0, 0, 0.0, 18, 0.0, 0, 0.0, 1), (0, 0, 0, 50, 0.0, 11, 0.0, 70, 0.1, 1), (0, 0, 1, 2, 0.0, 6, 0.0, 40, 0.0, 1),
        (0, 0, 1, 0, 0.0, 1, 0.0, 6, 0.0, 1), (0, 0, 0, 1, 0.0, 6, 0.0, 5, 0.0, 1), (0, 0, 0, 6, 0.0, 5, 0.0, 7, 0.0, 1),
        (0, 0, 0, 5, 0.0, 7, 0.0, 0, 0.0, 1), (0, 0, 0, 2, 0.0, 30, 0.0, 0, 0.0, 1), (0, 0, 0, 60, 0.0, 2, 0.0, 30, 0.0, 1),
        (0, 0, 0, 45, 0.0, 30, 0.0, 0, 0.0, 1), (0, 0, 1, 3, 1.0, 4, 0.0, 6, 0.0, 1), (0, 0, 0, 3, 1.0, 6, 0.0, 8, 0.0, 1),
        (0, 0, 0, 8, 0.0, 7, 0.0, 2, 1.0, 1), (0, 0, 0, 9, 0.0, 4, 0.0, 12, 0.0, 1), (0, 0, 0, 4, 0.0, 3, 0.0, 4, 0.0, 1),
        (0, 0, 0, 2, 0.0, 3, 0.0, 2, 0.0, 1), (0, 0, 0, 12, 0.0, 9, 0.0, 0, 0.0, 1), (0, 0, 1, 0, 0.0, 3, 0.0, 20, 0.0, 1),
        (0, 0, 0, 4, 0.0, 9, 0.2, 8, 0.0, 1), (0, 0, 1, 1, 1.0, 1, 0.0, 5, 0.0, 1), (0, 0, 0, 2, 1.0, 30, 0.0, 2, 1.0, 1),
        (0, 0, 0, 5, 0.0, 4, 0.0, 3, 1.0, 1), (0, 0, 0, 30, 0.0, 5, 0.1, 2, 1.0, 1), (0, 0, 1, 7, 0.0, 2, 0.0, 6, 0.0, 1),
        (0, 0, 0, 20, 1.0, 10, 0.0, 300, 0.0, 1), (0, 0, 0, 9, 1.0, 20, 0.0, 9, 0.0, 1), (0, 0, 0, 5, 1.0, 60, 0.0, 2, 1.0, 1),
        (0, 0, 0, 60, 1.0, 200, 0.1, 0, 0.0, 1), (0, 0, 1, 60, 1.0, 10, 0.0, 5, 0.2, 1), (0, 0, 0, 9, 1.0, 25, 0.1, 0, 0.0, 1),
        (0, 0, 0, 9, 0.0, 5, 0.0, 0, 0.0, 1), (0, 0, 1, 0, 0.0, 4, 0.1, 0, 0.0, 1), (0, 0, 0, 40, 0.1, 6, 0.1, 0, 0.0, 1),
        # their menus, teasers, footers, notices
        (0, 0, 0, 2, 1.0, 3, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 0.0, 1, 1.0, 2, 1.0, 0), (0, 0, 0, 3, 1.0, 2, 1.0, 40, 0.0, 0),
        (0, 0, 0, 60, 0.0, 7, 0.9, 8, 0.9, 0), (0, 0, 0, 3, 1.0, 9, 0.5, 4, 1.0, 0), (0, 0, 0, 40, 0.8, 30, 0.7, 35, 0.8, 0),
        (0, 0, 0, 2, 1.0, 6, 0.0, 3, 1.0, 0), (0, 0, 0, 5, 0.9, 4, 0.0, 0, 0.0, 0), 
        (0, 0, 1, 4, 1.0, 3, 0.0, 5, 1.0, 0), (0, 0, 1, 3, 1.0, 2, 0.5, 4, 1.0, 0), (0, 0, 0, 12, 1.0, 14, 0.8, 11, 1.0, 0),
        (0, 1, 0, 60, 0.0, 45, 0.0, 30, 0.0, 0), (0, 1, 0, 4, 0.0, 14, 0.2, 3, 1.0, 0), (0, 1, 0, 0, 0.0, 3, 1.0, 60, 0.0, 0),
        (0, 1, 1, 60, 0.0, 2, 0.0, 45, 0.0, 0), (0, 1, 0, 80, 0.0, 110, 0.0, 95, 0.0, 0), (0, 1, 0, 50, 0.0, 9, 0.0, 0, 0.0, 0),
        (0, 0, 0, 70, 0.0, 6, 0.3, 0, 0.0, 0), (0, 0, 0, 25, 0.7, 5, 0.0, 6, 0.9, 0), (0, 0, 0, 3, 0.7, 4, 0.3, 3, 0.7, 0),
    ],
    dtype=float,
)
#: Every second content block of the table stands in it once more as part of a marked element, where it is boilerplate.
_TWINS = LABELLED[LABELLED[:, -1] == 1][::2].copy()
_TWINS[:, FEATURES.index("marked")], _TWINS[:, -1] = 1, 0
LABELLED = np.concatenate([LABELLED, _TWINS])


def grow(table: np.ndarray, depth: int = 7, least: int = 1) -> tuple:
    """Classification tree by Gini impurity: ``(feature, cut, left, right)`` with ``x <= cut`` left, or a class."""
    labels = table[:, -1]
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0) or len(table) < 2 * least:
        return int(share >= 0.5)
    best = None
    for f in range(table.shape[1] - 1):
        order = np.argsort(table[:, f], kind="stable")
        x, y = table[order, f], labels[order]
        ones, n = np.cumsum(y), np.arange(1, len(y) + 1)
        cut_at = np.flatnonzero((x[:-1] < x[1:]) & (n[:-1] >= least) & (len(y) - n[:-1] >= least))
        if not len(cut_at):
            continue
        a, b = ones[cut_at] / n[cut_at], (ones[-1] - ones[cut_at]) / (len(y) - n[cut_at])
        cost = n[cut_at] * a * (1 - a) + (len(y) - n[cut_at]) * b * (1 - b)
        k = int(np.argmin(cost))
        if best is None or cost[k] < best[0] - 1e-12:
            best = (cost[k], f, (x[cut_at[k]] + x[cut_at[k] + 1]) / 2)
    if best is None:
        return int(share >= 0.5)
    _, f, cut = best
    left = table[:, f] <= cut
    return (f, float(cut), grow(table[left], depth - 1, least), grow(table[~left], depth - 1, least))


def is_content(tree: tuple | int, x: tuple) -> bool:
    while not isinstance(tree, int):
        f, cut, left, right = tree
        tree = left if x[f] <= cut else right
    return tree == 1


def described(found: list[Block]) -> list[tuple]:
    """The blocks' features."""
    has_article = any(b.inside for b in found)
    around = [(0, 0.0), *[(b.words, b.link_density) for b in found], (0, 0.0)]
    return [
        (1 if b.inside else -has_article, b.marked, b.heading, *around[i], *around[i + 1], *around[i + 2])
        for i, b in enumerate(found)
    ]


def main_text(html: str | None, tree: tuple) -> str:
    """Content blocks of a page in order, one line each."""
    found = blocks(html)
    return "\n".join(b.text for b, x in zip(found, described(found), strict=True) if is_content(tree, x))


def extract(pages: DataFrame, html: str = "html", out: str = "text", table: np.ndarray = LABELLED) -> DataFrame:
    """Replace the page by its main text: content blocks, white space in a block as one blank, blocks joined by a line feed.

    A null or empty page, or one without content, gives an empty text; equal rows give equal texts, no rows none. A page is read whole by
    one task, however long. Markup that is cut off or never closed ends with
    the page. Other columns stay, but for one called like ``out``. ``table`` trains the tree; its columns are
    ``FEATURES`` and the label.
    """
    keep = [c for c in pages.columns if c.lower() not in (html.lower(), out.lower())]
    tree = grow(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h.as_py(), tree) for h in b.columns[-1]], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], names=[*keep, out])

    rest = pages.select(*[column(pages, c) for c in keep])
    schema = rest.withColumn(out, F.lit("x")).schema
    for f in schema.fields:
        f.nullable = True
    return pages.select(*[column(pages, c) for c in keep], column(pages, html)).mapInArrow(run, schema)
