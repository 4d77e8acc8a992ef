"""Main text of web pages: flat text blocks, judged by a decision tree over their own and their neighbours' shape.

A page is read once as a stream of tags and text, without a tree of elements. Block-level tags end a block; inline
tags do not. Each block has its number of words, the share of its words inside links, the same two numbers of the
blocks before and behind, whether it is a paragraph or heading, whether a name around it has a word of boilerplate
among others (`share-price`), and its place: inside a container of boilerplate, outside the page's article, on a page
without an article, or inside the article. A small decision tree, grown on the labelled table below, keeps or
drops it. A container of boilerplate is one by its tag or by a whole name (`comments`, `ad-banner`), never by a part of
a name. The header of an article is part of it; an article named as a teaser or comment is none.

Defined results: null html is empty; a page without a kept block has the empty text. White space of any kind inside
a block becomes one space. Unclosed comments, scripts and styles reach to the end of the page. Elements that are not
closed end with the element around them. Repeated pages are read each. Other columns are not read.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


_DROPPED = "script|style|noscript|template|textarea|title|select|svg|iframe|button|datalist"
_TOKEN = re.compile(
    rf"""<!--.*?(?:--!?>|\Z)
    | <(?P<raw>{_DROPPED})\b(?:[^>"']+|"[^"]*"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)
    | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']+|"[^"]*"|'[^']*')*+)>
    | </?[a-zA-Z][^>]*(?:>|\Z)
    | <[!?/][^>]*(?:>|\Z)""",
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
_ARTICLE = frozenset(("article", "main"))
_HINT = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_WORDS_OF_BOILERPLATE = frozenset(
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr header legal login masthead "
    "menu modal nav navbar navigation newsletter notice overlay pager pagination paywall popup promo related "
    "respond reply replies share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that leave a name as much boilerplate as it is without them.
_NEUTRAL = frozenset(
    "area article articles bar block body bottom box button buttons col column container content foot form group head "
    "icon icons inner item items js left link links list main middle module outer page panel post posts right row section "
    "site slot small story stories text thread title top unit wrap wrapper".split()
)
_AROUND = frozenset("has with no without is".split())
#: Names by which an article is no article of the page.
_OTHER_ARTICLE = frozenset(
    "ad ads advert advertisement comment comments preview promo recommended related replies reply sponsored teaser teasers".split()
)
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt td th".split())
_SPLIT = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    paragraph: bool
    hinted: bool
    place: int


#: Places: in a container of boilerplate, outside the page's article, page without an article, in the article.
BOILERPLATE, OUTSIDE, UNKNOWN, INSIDE = range(4)


#: How much a container's names say of boilerplate: nothing, a word among others, the whole name.
PLAIN, HINTED, NAMED = range(3)


def _names(attributes: str) -> Iterator[list[str]]:
    """The words of each class, id and role, and of the label as a whole."""
    for attribute, *values in _HINT.findall(attributes):
        value = "".join(values).lower()
        for name in [value] if attribute.lower() == "aria-label" else value.split():
            yield _SPLIT.findall(name)


@functools.lru_cache(4096)
def _kind(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _BOILERPLATE and not (tag == "header" and in_article):
        return NAMED
    if not attributes or tag in ("body", "html"):
        return PLAIN
    if _HIDDEN.search(attributes):
        return NAMED
    kind, wanted = PLAIN, _OTHER_ARTICLE if tag in _ARTICLE else _WORDS_OF_BOILERPLATE
    for words in _names(attributes):
        # "has-sidebar" and the like are said of what is around the sidebar
        if words and words[0] not in _AROUND and not wanted.isdisjoint(words):
            if all(w in wanted or w in _NEUTRAL for w in words):
                return NAMED
            kind = HINTED
    return kind


def blocks(html: str | None) -> list[Block]:
    """Text blocks of a page in their order."""
    page = html or ""
    found: list[tuple] = []  # text, words, words in links, paragraph, hinted, boilerplate, in article
    open_tags: list[tuple[str, int, bool]] = []  # block-level elements around: tag, kind, article
    open_names: Counter[str] = Counter()
    bad = hinted = good = link = 0
    paragraph = False
    text: list[str] = []
    linked: list[str] = []
    any_article = False

    def end_block():
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                in_links = len(entities.unescape(" ".join(linked)).split())
                found.append((joined, joined.count(" ") + 1, in_links, paragraph, hinted > 0, bad > 0, good > 0))
            text.clear()
            linked.clear()

    def add(part: str):
        if part:
            text.append(part)
            if link:
                linked.append(part)

    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "a":
                link = 0 if token["close"] else 1
            elif tag == "br":
                add(" ")
            elif not token["close"] and token["attributes"] and tag == "span" and _HIDDEN.search(token["attributes"]):
                end_block()
            continue
        end_block()
        if tag in _VOID:
            continue
        if not token["close"]:
            paragraph = tag in _PARAGRAPH
            if tag == "p":  # paragraphs hold no blocks, so they are never around one
                continue
            kind = _kind(tag, token["attributes"], good > 0)
            article = tag in _ARTICLE and kind != NAMED
            any_article |= article
            open_tags.append((tag, kind, article))
            open_names[tag] += 1
            bad += kind == NAMED
            hinted += kind == HINTED
            good += article
            continue
        paragraph = False
        if open_names[tag]:
            link = 0
            name = ""
            while name != tag:
                name, kind, article = open_tags.pop()
                open_names[name] -= 1
                bad -= kind == NAMED
                hinted -= kind == HINTED
                good -= article
    add(page[at:])
    end_block()
    out = []
    for joined, words, in_links, is_paragraph, is_hinted, worse, article in found:
        place = BOILERPLATE if worse else INSIDE if article else OUTSIDE if any_article else UNKNOWN
        out.append(Block(joined, words, min(1.0, in_links / words), is_paragraph, is_hinted, place))
    return out


def features(found: list[Block]) -> np.ndarray:
    """Rows: words and link density of the block, of the one before and of the one behind, then what is around it."""
    own = np.array([(b.words, b.link_density) for b in found]).reshape(-1, 2)
    edge = np.zeros((1, 2))
    before, behind = np.concatenate((edge, own[:-1])), np.concatenate((own[1:], edge))
    return np.column_stack((own, before, behind, [(b.paragraph, b.hinted, b.place) for b in found]))


# Labelled by hand: words, link density, words and link density before, words and link density behind, paragraph, word of
# boilerplate in a name around, place, main text.
LABELLED = (
    # inside an article: prose, short lines between prose, headings, one-word paragraphs, last lines
    (80, 0.00, 60, 0.00, 70, 0.00, 1, 0, INSIDE, 1),
    (45, 0.05, 8, 0.00, 90, 0.02, 1, 0, INSIDE, 1),
    (7, 0.00, 0, 0.00, 60, 0.00, 1, 0, INSIDE, 1),
    (1, 0.00, 50, 0.00, 40, 0.00, 0, 0, INSIDE, 1),
    (1, 0.00, 1, 0.00, 2, 0.00, 1, 0, INSIDE, 1),
    (3, 0.00, 12, 1.00, 9, 0.50, 1, 0, INSIDE, 1),
    (12, 0.10, 90, 0.00, 8, 0.30, 1, 0, INSIDE, 1),
    (150, 0.20, 10, 0.00, 1, 0.00, 0, 0, INSIDE, 1),
    (30, 0.35, 40, 0.10, 35, 0.00, 1, 0, INSIDE, 1),
    (2, 0.00, 0, 0.00, 0, 0.00, 1, 0, INSIDE, 1),
    (20, 0.45, 25, 0.05, 60, 0.00, 1, 0, INSIDE, 1),
    (6, 0.50, 80, 0.00, 75, 0.00, 0, 0, INSIDE, 1),
    (5, 0.00, 2, 0.00, 3, 0.00, 1, 0, INSIDE, 1),
    (10, 0.00, 100, 0.00, 0, 0.00, 1, 0, INSIDE, 1),
    (1, 0.00, 8, 0.00, 0, 0.00, 1, 0, INSIDE, 1),
    (13, 0.00, 1, 0.00, 14, 0.00, 0, 0, INSIDE, 1),
    (55, 0.00, 3, 0.00, 0, 0.00, 1, 0, INSIDE, 1),
    (8, 0.20, 12, 0.00, 10, 0.10, 1, 0, INSIDE, 1),
    (22, 0.00, 1, 0.00, 6, 1.00, 1, 0, INSIDE, 1),
    (4, 0.60, 15, 0.00, 12, 0.00, 0, 0, INSIDE, 1),
    (3, 0.00, 50, 0.00, 4, 1.00, 1, 0, INSIDE, 1),
    (10, 0.00, 80, 0.00, 6, 0.80, 1, 0, INSIDE, 1),
    (1, 0.00, 20, 0.00, 2, 1.00, 1, 0, INSIDE, 1),
    (6, 0.00, 90, 0.00, 30, 0.60, 0, 0, INSIDE, 1),
    (5, 0.20, 1, 1.00, 9, 1.00, 1, 0, INSIDE, 1),
    (18, 0.00, 4, 1.00, 4, 1.00, 1, 0, INSIDE, 1),
    (70, 0.10, 6, 0.50, 12, 0.90, 1, 0, INSIDE, 1),
    # inside an article: rows of links
    (4, 1.00, 3, 1.00, 5, 1.00, 0, 0, INSIDE, 0),
    (6, 1.00, 70, 0.00, 6, 1.00, 0, 0, INSIDE, 0),
    (5, 1.00, 6, 1.00, 8, 0.50, 0, 0, INSIDE, 0),
    (9, 1.00, 9, 1.00, 0, 0.00, 0, 0, INSIDE, 0),
    (2, 1.00, 60, 0.00, 2, 1.00, 0, 0, INSIDE, 0),
    # inside an article: single links, paragraphs that are one link
    (8, 1.00, 60, 0.00, 70, 0.00, 1, 0, INSIDE, 1),
    (40, 1.00, 50, 0.00, 45, 0.00, 1, 0, INSIDE, 1),
    (20, 1.00, 0, 0.00, 30, 0.00, 1, 0, INSIDE, 1),
    (5, 1.00, 6, 1.00, 7, 1.00, 1, 0, INSIDE, 1),
    (12, 1.00, 80, 0.00, 9, 1.00, 1, 0, INSIDE, 1),
    (3, 1.00, 2, 1.00, 90, 0.00, 1, 0, INSIDE, 1),
    (40, 1.00, 0, 0.00, 0, 0.00, 1, 0, INSIDE, 1),
    (15, 1.00, 15, 1.00, 0, 0.00, 1, 0, INSIDE, 1),
    (3, 0.80, 20, 0.60, 0, 0.00, 1, 0, INSIDE, 1),
    (6, 1.00, 70, 0.00, 60, 0.00, 0, 0, INSIDE, 1),
    (15, 1.00, 30, 0.00, 25, 0.05, 0, 0, INSIDE, 1),
    # inside an article: text outside paragraphs is as good as in them
    (1, 0.00, 0, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (1, 0.00, 50, 0.00, 50, 0.00, 0, 0, INSIDE, 1),
    (2, 0.50, 50, 0.00, 50, 0.00, 0, 0, INSIDE, 1),
    (3, 0.00, 0, 0.00, 0, 0.00, 0, 1, INSIDE, 1),
    (4, 0.00, 5, 1.00, 5, 1.00, 0, 0, INSIDE, 1),
    (5, 0.00, 0, 0.00, 40, 0.00, 0, 1, INSIDE, 1),
    (6, 0.30, 3, 0.00, 4, 0.00, 0, 0, INSIDE, 1),
    (7, 0.50, 6, 1.00, 7, 1.00, 0, 0, INSIDE, 1),
    (8, 0.00, 4, 1.00, 90, 0.00, 0, 1, INSIDE, 1),
    (10, 0.00, 0, 0.00, 6, 0.00, 0, 0, INSIDE, 1),
    (12, 0.60, 8, 0.90, 9, 0.80, 0, 0, INSIDE, 1),
    (14, 0.00, 90, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (18, 0.00, 18, 0.00, 18, 0.00, 0, 1, INSIDE, 1),
    (20, 0.10, 2, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (30, 0.00, 3, 1.00, 3, 1.00, 0, 0, INSIDE, 1),
    (45, 0.50, 6, 1.00, 6, 1.00, 0, 0, INSIDE, 1),
    (60, 0.00, 0, 0.00, 1, 0.00, 0, 0, INSIDE, 1),
    (3, 1.00, 0, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (5, 1.00, 40, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (40, 1.00, 50, 0.00, 50, 0.00, 0, 0, INSIDE, 1),
    (1, 1.00, 50, 0.00, 50, 0.00, 0, 0, INSIDE, 1),
    (1, 0.00, 70, 0.00, 0, 0.00, 0, 0, INSIDE, 1),
    (1, 0.00, 120, 0.00, 9, 0.00, 0, 1, INSIDE, 1),
    (2, 0.00, 90, 0.00, 30, 0.00, 0, 0, INSIDE, 1),
    (2, 0.40, 60, 0.10, 2, 0.00, 1, 0, INSIDE, 1),
    (9, 0.00, 9, 1.00, 0, 0.00, 0, 0, INSIDE, 1),
    (9, 0.00, 30, 0.00, 12, 0.00, 0, 0, INSIDE, 1),
    (9, 0.30, 8, 0.80, 2, 0.40, 0, 0, INSIDE, 1),
    (6, 0.00, 7, 1.00, 6, 0.00, 0, 0, INSIDE, 1),
    (3, 0.50, 3, 1.00, 4, 0.30, 0, 0, INSIDE, 1),
    (25, 0.00, 5, 1.00, 30, 0.00, 1, 0, INSIDE, 1),
    (4, 0.50, 9, 1.00, 80, 0.00, 1, 1, INSIDE, 1),
    (2, 0.00, 6, 1.00, 3, 0.00, 0, 1, INSIDE, 1),
    # inside an article, a name around has a word of boilerplate among others
    (40, 0.00, 0, 0.00, 40, 0.00, 1, 1, INSIDE, 1),
    (45, 0.00, 40, 0.00, 0, 0.00, 1, 1, INSIDE, 1),
    (3, 0.00, 60, 0.00, 50, 0.00, 1, 1, INSIDE, 1),
    (2, 0.00, 9, 0.00, 4, 0.00, 0, 1, INSIDE, 1),
    (70, 0.10, 60, 0.00, 80, 0.00, 0, 1, INSIDE, 1),
    (25, 0.20, 3, 0.00, 30, 0.40, 1, 1, INSIDE, 1),
    (9, 1.00, 40, 0.00, 30, 0.00, 1, 1, INSIDE, 1),
    (3, 1.00, 3, 1.00, 4, 1.00, 0, 1, INSIDE, 0),
    # containers of boilerplate, whatever they hold
    (1, 1.00, 1, 1.00, 1, 1.00, 1, 0, BOILERPLATE, 0),
    (8, 0.00, 1, 1.00, 10, 0.00, 0, 0, BOILERPLATE, 0),
    (60, 0.00, 50, 0.00, 55, 0.00, 1, 1, BOILERPLATE, 0),
    (12, 0.00, 70, 0.00, 0, 0.00, 0, 0, BOILERPLATE, 0),
    (120, 0.00, 4, 0.00, 90, 0.00, 1, 0, BOILERPLATE, 0),
    (25, 0.30, 80, 0.00, 6, 0.80, 0, 0, BOILERPLATE, 0),
    (3, 0.00, 0, 0.00, 3, 1.00, 1, 0, BOILERPLATE, 0),
    (40, 0.10, 1, 0.00, 12, 0.00, 0, 1, BOILERPLATE, 0),
    (200, 0.00, 150, 0.00, 5, 0.00, 1, 0, BOILERPLATE, 0),
    (90, 0.00, 3, 1.00, 0, 0.00, 0, 0, BOILERPLATE, 0),
    (70, 0.10, 60, 0.00, 10, 0.00, 1, 0, BOILERPLATE, 0),
    (16, 0.00, 8, 0.00, 14, 0.00, 0, 0, BOILERPLATE, 0),
    (5, 0.00, 40, 0.00, 45, 0.00, 1, 1, BOILERPLATE, 0),
    (1, 0.00, 30, 0.00, 60, 0.00, 0, 0, BOILERPLATE, 0),
    (100, 0.40, 90, 0.30, 80, 0.20, 1, 0, BOILERPLATE, 0),
    (33, 0.00, 33, 0.00, 2, 0.00, 0, 0, BOILERPLATE, 0),
    (14, 0.00, 5, 0.00, 120, 0.00, 1, 0, BOILERPLATE, 0),
    (11, 0.00, 0, 0.00, 6, 0.00, 0, 1, BOILERPLATE, 0),
    # outside the article of a page that has one
    (180, 0.00, 120, 0.00, 3, 0.00, 1, 0, OUTSIDE, 0),
    (75, 0.05, 2, 0.00, 0, 0.00, 0, 0, OUTSIDE, 0),
    (95, 0.00, 60, 0.00, 12, 0.00, 1, 0, OUTSIDE, 0),
    (1, 0.00, 45, 0.00, 50, 0.00, 0, 0, OUTSIDE, 0),
    (6, 0.00, 30, 0.00, 90, 0.00, 1, 1, OUTSIDE, 0),
    (18, 0.00, 12, 0.00, 9, 0.00, 0, 0, OUTSIDE, 0),
    (28, 0.00, 70, 0.00, 14, 0.00, 1, 0, OUTSIDE, 0),
    (9, 0.00, 1, 1.00, 11, 0.00, 0, 0, OUTSIDE, 0),
    (70, 0.00, 80, 0.00, 60, 0.00, 1, 0, OUTSIDE, 0),
    (4, 1.00, 4, 1.00, 9, 0.00, 0, 1, OUTSIDE, 0),
    (15, 0.20, 120, 0.00, 0, 0.00, 1, 0, OUTSIDE, 0),
    (35, 0.00, 6, 0.00, 40, 0.00, 0, 0, OUTSIDE, 0),
    # pages without an article: prose and what stands between prose
    (70, 0.00, 60, 0.00, 65, 0.00, 0, 0, UNKNOWN, 1),
    (40, 0.08, 5, 0.00, 50, 0.00, 1, 0, UNKNOWN, 1),
    (25, 0.15, 70, 0.00, 40, 0.10, 1, 1, UNKNOWN, 1),
    (16, 0.00, 20, 0.00, 18, 0.00, 0, 0, UNKNOWN, 1),
    (14, 0.00, 40, 0.00, 4, 0.00, 1, 0, UNKNOWN, 1),
    (8, 0.00, 45, 0.00, 60, 0.00, 1, 0, UNKNOWN, 1),
    (6, 0.00, 2, 1.00, 70, 0.00, 0, 0, UNKNOWN, 1),
    (3, 0.00, 50, 0.00, 30, 0.00, 1, 1, UNKNOWN, 1),
    (1, 0.00, 35, 0.00, 40, 0.00, 1, 0, UNKNOWN, 1),
    (90, 0.25, 3, 0.00, 5, 1.00, 0, 0, UNKNOWN, 1),
    (30, 0.05, 0, 0.00, 0, 0.00, 1, 0, UNKNOWN, 1),
    (18, 0.00, 0, 0.00, 25, 0.00, 1, 0, UNKNOWN, 1),
    (12, 0.00, 30, 0.05, 28, 0.00, 0, 1, UNKNOWN, 1),
    (40, 0.00, 2, 0.00, 1, 0.00, 1, 0, UNKNOWN, 1),
    (25, 0.00, 30, 0.00, 3, 0.00, 1, 0, UNKNOWN, 1),
    (60, 0.00, 50, 0.00, 0, 0.00, 0, 0, UNKNOWN, 1),
    (80, 0.00, 4, 1.00, 6, 1.00, 1, 0, UNKNOWN, 1),
    (35, 0.10, 9, 0.00, 2, 0.00, 1, 1, UNKNOWN, 1),
    (22, 0.00, 1, 1.00, 5, 1.00, 0, 0, UNKNOWN, 1),
    (17, 0.05, 3, 1.00, 4, 0.00, 1, 0, UNKNOWN, 1),
    # pages without an article: menus, lists of links, lines at the edges
    (1, 1.00, 1, 1.00, 1, 1.00, 0, 0, UNKNOWN, 0),
    (3, 1.00, 60, 0.00, 4, 1.00, 0, 0, UNKNOWN, 0),
    (12, 0.90, 10, 0.95, 9, 1.00, 0, 1, UNKNOWN, 0),
    (20, 0.70, 8, 1.00, 12, 0.80, 0, 0, UNKNOWN, 0),
    (4, 0.00, 2, 1.00, 3, 1.00, 0, 0, UNKNOWN, 0),
    (6, 0.00, 4, 0.00, 0, 0.00, 1, 0, UNKNOWN, 0),
    (5, 0.00, 80, 0.00, 0, 0.00, 0, 0, UNKNOWN, 0),
    (7, 0.40, 3, 1.00, 6, 0.50, 0, 1, UNKNOWN, 0),
    (2, 0.00, 0, 0.00, 3, 1.00, 0, 0, UNKNOWN, 0),
    (9, 0.50, 40, 0.00, 0, 0.00, 0, 0, UNKNOWN, 0),
    (3, 0.00, 5, 0.00, 4, 0.00, 0, 0, UNKNOWN, 0),
    (8, 0.00, 3, 1.00, 5, 0.60, 0, 0, UNKNOWN, 0),
    (1, 1.00, 1, 1.00, 40, 0.00, 0, 0, UNKNOWN, 0),
    (2, 1.00, 0, 0.00, 60, 0.00, 0, 0, UNKNOWN, 0),
    (4, 1.00, 4, 1.00, 80, 0.00, 0, 0, UNKNOWN, 0),
    (6, 0.80, 2, 0.00, 120, 0.00, 0, 1, UNKNOWN, 0),
    (1, 1.00, 90, 0.00, 70, 0.00, 0, 0, UNKNOWN, 0),
    (3, 1.00, 30, 0.00, 0, 0.00, 1, 0, UNKNOWN, 0),
    (30, 0.60, 10, 0.90, 25, 0.70, 0, 1, UNKNOWN, 0),
    (10, 0.10, 60, 0.00, 3, 1.00, 1, 0, UNKNOWN, 0),
)


@dataclass(frozen=True)
class Node:
    """A leaf has a value; another node sends rows of at most `limit` left."""

    value: int
    feature: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(rows), self.value, np.int8)
        low = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), np.int8)
        out[low], out[~low] = self.left.predict(rows[low]), self.right.predict(rows[~low])
        return out


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean()
    return 2 * share * (1 - share) * len(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 1) -> Node:
    """Decision tree by the largest drop of the Gini impurity; ties go to the later feature and the wider gap."""
    value = int(labels.mean() >= 0.5)
    if depth == 0 or len(set(labels.tolist())) == 1:
        return Node(value)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for low, high in zip(values, values[1:]):
            side = rows[:, feature] <= (low + high) / 2
            if min(side.sum(), (~side).sum()) < least:
                continue
            left = _impurity(labels[side]) + _impurity(labels[~side])
            rank = (-round(left, 9), feature, (high - low) / (values[-1] - values[0]))
            if best is None or rank > best[0]:
                best = (rank, feature, (low + high) / 2, side)
    if best is None:
        return Node(value)
    _, feature, limit, side = best
    return Node(value, feature, float(limit), grow(rows[side], labels[side], depth - 1, least), grow(rows[~side], labels[~side], depth - 1, least))


@functools.cache
def tree() -> Node:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def main_text(html: str | None) -> str:
    found = blocks(html)
    if not found:
        return ""
    keep = tree().predict(features(found))
    return " ".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; no shuffle."""
    names = ["page_id", "url", "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names,
                )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
