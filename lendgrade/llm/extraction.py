"""Main-text extraction from HTML by a maximum-scoring subsequence.

A page is a sequence of tokens: tags, and words between them. Every token has
a weight: the log-odds, on labelled pages, of lying inside the content. A word
is weighed by the last structural tag before it, a tag by its name and class
(words lean to positive weights, tags to negative ones, also where nothing was
learned). One linear scan finds the contiguous run of greatest total weight,
the content region; what it holds of scripts, menus, notices, adverts, forms
and reader comments is left out of the text, and does not cut the region
however long it is. An element is furniture by its tag or by a whole class, id
or role, not by a part of one; a header is, unless it is inside the content.

Labelled pages are those whose markup names the content itself, by one
``article`` (or ``main``) element; a bounded sample of them is learned from.

Results at the edges: a null or empty page, or one without a word, has the
text "" and no characters. Broken markup is read as far as it goes: an
element ends at the end of the one around it. Repeated rows give repeated
results; an empty table gives an empty result; only the columns named are
read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendgrade.llm import learning
from lendgrade.llm.common import score_partitions

#: Bounds of the learning sample: pages, characters of one.
LEARN_PAGES, LEARN_CHARS = 1000, 200_000

#: A comment, a declaration, a self-closed svg, raw elements with their content,
#: or a tag. An unfinished one reaches to the end of the page.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(svg)(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|noscript|template|textarea|svg|iframe|object)(?=[\s/>])[^>]*>.*?(?:</\2\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)",
    re.S | re.I,
)
HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# fixed values: element names of HTML and usual names of page furniture
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head nav aside footer form button select option fieldset label dialog menu audio video canvas map title".split())
FURNITURE = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "cookie cookies consent notice notices alert popup modal newsletter subscribe signup login share sharing social related recommended "
    "comment comments discussion replies disqus footer header copyright masthead topbar toolbar pagination pager widget".split()
)
#: Of these, names that content may have as well.
AMBIGUOUS = frozenset("notice notices alert related recommended copyright share sharing social discussion replies promotion promo widget".split())
#: Words that stand beside a furniture name in a compound without changing it
#: (site-footer, ad_box); any other word does (ad-hoc, has-sidebar, banner-title).
BESIDE = frozenset("site top bottom left right global main primary secondary bar box block container wrapper wrap list area section inner outer item items links".split())
#: Names of comments, which may hold more words than the article.
COMMENTS = frozenset("comment comments discussion replies disqus".split())
CONTENT = ("article", "main")
#: Classes, ids and roles of elements that hold the content, as whole names.
CONTENT_NAMES = frozenset("content article post entry story main main-content page-content article-content article-body post-content post-body entry-content story-body".split())
#: Elements that begin a new one of their own kind.
SIBLINGS = frozenset("p li tr td th dt dd option".split())
#: An element left out by name holds the content after all if it holds so much
#: of the words that are not in elements left out by their tag.
MOST = 0.9


def _furniture_name(name: str) -> str | None:
    """The furniture name that a whole class, id or role is: the name itself,
    or a compound of furniture names and words that may stand beside them."""
    if name in FURNITURE:
        return name
    parts = re.split(r"[_-]+", name)
    if len(parts) > 1 and all(p in FURNITURE or p in BESIDE or p.isdigit() for p in parts):
        return next((p for p in parts if p in FURNITURE), None)
    return None


def names_of(attributes: str) -> tuple[str | None, bool]:
    """The first furniture name among an element's classes, id and role (an
    ambiguous one only of classes and role, and if there is no other), and
    whether one of them names the content."""
    if "=" not in attributes:
        return None, False
    sure, unsure, content = None, None, False
    for m in HINT.finditer(attributes):
        for whole in (m[1] or m[2] or m[3] or "").lower().split():
            content = content or whole in CONTENT_NAMES
            name = _furniture_name(whole)
            if name in AMBIGUOUS:
                if unsure is None and m[0][:2].lower() != "id":
                    unsure = name
            elif sure is None:
                sure = name
    return sure or unsure, content


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, name, text, furniture) in page order; kind is open, close, raw
    or text. The text of an open tag tells whether its names are of content."""
    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()], False
        at = m.end()
        name = m[4]
        if name is None:
            if m[1] or m[2]:
                yield "raw", (m[1] or m[2]).lower(), "", True
            continue
        name = name.lower()
        if m[3]:
            yield "close", name, "", False
        else:
            hint, content = names_of(m[5])
            yield "open", f"{name}.{hint}" if hint else name, "content" if content else "", hint is not None
    if at < len(page):
        yield "text", "", page[at:], False


class Weights:
    """Log-odds of lying inside the content, by feature."""

    WORD, TAG, LEAST = 1.0, -0.3, -3.0

    def __init__(self, counts: dict[str, list[int]] | None = None):
        # a feature's own counts outweigh the leaning once it is seen a few times
        self.of = {f: math.log((i + 0.5) / (o + 0.5)) for f, (o, i) in (counts or {}).items() if o + i >= 5}

    def word(self, context: str) -> float:
        known = self.of.get(f"w {context}")
        if known is not None:
            return max(self.LEAST, min(3.0, known))
        name, _, hint = context.lstrip("</").partition(".")
        hint = hint not in AMBIGUOUS and hint
        return -1.0 if hint or (name in LEFT_OUT and context[:2] != "</") else self.WORD

    def outside(self, name: str, named: bool, content: bool) -> bool:
        """Whether an element is left out, by its name; an ambiguous one by its
        learned weight, else if no element that names the content is open."""
        base, _, hint = name.partition(".")
        if (base == "header" or hint == "header") and base not in LEFT_OUT:  # of the site, or of the content
            return not content and base not in CONTENT and base != "body"
        if hint not in AMBIGUOUS or base in LEFT_OUT:
            return base not in CONTENT and base != "body" and (named or base in LEFT_OUT)
        known = self.of.get(f"w <{name}")
        return base not in CONTENT and base != "body" and (not content if known is None else known < 0)

    def tag(self, feature: str) -> float:
        return max(self.LEAST, min(0.0, self.of.get(f"t {feature}", self.TAG)))


def features(page: str) -> Iterator[tuple[str, int, tuple[str, str, str, bool]]]:
    """(feature, times, token): each tag once, each text as often as it has
    words, with the last structural tag as context."""
    context = ""
    for token in tokens(page):
        kind, name, text, _ = token
        if kind == "text":
            yield f"w {context}", len(text.split()), token
        else:
            feature = ("</" if kind == "close" else "<") + name
            if name.partition(".")[0] not in INLINE and name != "br":
                context = feature
            yield f"t {feature}", 1, token


def learn(pages: list[str]) -> Weights:
    """Weights from pages whose markup names the content by one element."""
    counts: dict[str, list[int]] = {}
    for page in pages:
        items = list(features(page))
        for name in CONTENT:
            begin = [i for i, (_, _, t) in enumerate(items) if t[0] == "open" and t[1].partition(".")[0] == name]
            if len(begin) == 1:
                end = [i for i, (_, _, t) in enumerate(items) if t[0] == "close" and t[1] == name and i > begin[0]]
                if end:
                    for i, (f, n, _) in enumerate(items):
                        counts.setdefault(f, [0, 0])[begin[0] <= i <= end[-1]] += n
                break
    return Weights(counts)


def left_out(items: list[tuple[str, int, tuple[str, str, str, bool]]], weights: Weights) -> list[bool]:
    """Of every token, whether it belongs to an element that is left out.

    An element that is to be left out by its names stays if it holds the
    content after all: if an ``article``, ``main`` or ``h1`` begins inside it
    (in a header, or one left out by its tag other than a form, no ``h1``
    counts), or, if it is left out by a class, id or role other than those of
    comments, ``MOST`` of the words outside elements left out by their tag.
    """
    # elements in the order they open, each after the one around it; 0: the page
    parent, names, words, holds, out = [0], [""], [0], [0], [False]
    stack, opened, content, own = [0], {}, 0, []

    def close() -> str:
        nonlocal content
        e = stack.pop()
        base = names[e].partition(".")[0]
        opened[base] -= 1
        content -= inside[e]
        words[parent[e]] += words[e]
        holds[parent[e]] |= holds[e] | (2 if base in CONTENT else 1 if base == "h1" else 0)
        return base

    inside = [False]
    for _, n, (kind, name, text, named) in items:
        base = name.partition(".")[0]
        if kind == "open":
            if base in SIBLINGS and any(names[e].partition(".")[0] == base for e in stack[-3:] if e):
                while close() != base:
                    pass
            if base not in VOID:
                parent.append(stack[-1])
                names.append(name)
                words.append(0)
                holds.append(0)
                out.append(weights.outside(name, named, content > 0))
                inside.append(base in CONTENT or text == "content")
                content += inside[-1]
                stack.append(len(names) - 1)
                opened[base] = opened.get(base, 0) + 1
            own.append(stack[-1])
            continue
        own.append(stack[-1])
        if kind == "text":
            words[stack[-1]] += n
        elif kind == "close" and opened.get(base):
            while close() != base:
                pass
    while len(stack) > 1:
        close()
    # words outside the elements left out by their tag
    by_tag, there = [False], words[0]
    for e in range(1, len(names)):
        tag = out[e] and names[e].partition(".")[0] in LEFT_OUT
        by_tag.append(by_tag[parent[e]] or tag)
        if tag and not by_tag[parent[e]]:
            there -= words[e]
    for e in range(1, len(names)):
        if out[e]:
            base, _, hint = names[e].partition(".")
            weak = base in LEFT_OUT - {"form", "fieldset", "label"} or "header" in (base, hint)
            wrapper = holds[e] >= (2 if weak else 1) or (base not in LEFT_OUT and not weak and hint not in COMMENTS and words[e] > MOST * there)
            out[e] = not wrapper
        out[e] = out[e] or out[parent[e]]
    return [out[e] for e in own]


def region(items: list[tuple[str, int, tuple[str, str, str, bool]]], weights: Weights, left: list[bool] | None = None) -> tuple[int, int]:
    """The run [i, j) of greatest total weight, by one linear scan; of equal
    runs the first and longest. Empty if no word has a positive weight. The
    words of an element left out weigh nothing, its tags together no less than
    one tag can, so that its size does not cut the content around it."""
    left = left_out(items, weights) if left is None else left
    best, found, total, begin, spent = 0.0, (0, 0), 0.0, 0, 0.0
    for i, (f, n, token) in enumerate(items):
        if total < 0:
            total, begin = 0.0, i
        if not left[i]:
            spent = 0.0
            total += n * weights.word(f[2:]) if token[0] == "text" else weights.tag(f[2:])
        elif token[0] != "text":
            tag = max(weights.tag(f[2:]), weights.LEAST - spent)
            spent += tag
            total += tag
        if n and token[0] == "text" and total >= best and total > 0 and not left[i]:
            best, found = total, (begin, i + 1)
    return found


def main_text(page: str, weights: Weights) -> str:
    """The text of the content region, blocks joined by one space."""
    items = list(features(page))
    left = left_out(items, weights)
    first, last = region(items, weights, left)
    out: list[str] = []
    for i, (_, _, (kind, name, text, _)) in enumerate(items):
        if kind != "text":
            if name.partition(".")[0] not in INLINE:
                out.append(" ")
        elif first <= i < last and not left[i]:
            out.append(_html.unescape(text))
    return " ".join("".join(out).split())


def labelled_pages(pages: DataFrame, page: str, key: str, wanted: int) -> list[str]:
    """About ``wanted`` pages that name their content, never more, by a bound
    on a hash of the row; the bound grows while too few are found, so what
    reaches the driver does not grow with the table."""
    h = F.col(f"`{page}`")
    rows = pages.select(h.alias("h"), learning.hash31(F.col(f"`{key}`"), h).alias("o"))
    rows = rows.where(F.col("h").rlike(r"(?i)<(article|main)\b") & (F.length("h") <= LEARN_CHARS))
    low, high, found = 0, learning.below(wanted, pages.count()), []
    while True:
        found += [(r["o"], r["h"]) for r in rows.where((F.col("o") >= low) & (F.col("o") < high)).collect()]
        if high >= 2**31 or 2 * len(found) >= wanted:
            return [x for _, x in sorted(found)[:wanted]]
        low, high = high, min(2**31, high + (high - low) * max(2, min(64, wanted // (2 * len(found) + 1))))


def extract(pages: DataFrame, page: str = "html", keep: list[str] | None = None, key: str = "page_id", learn_pages: int = LEARN_PAGES) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every whole page; the
    weights come from ``learn_pages`` labelled pages at most."""
    weights = learn(labelled_pages(pages, page, key, learn_pages))
    sent = pages.sparkSession.sparkContext.broadcast(weights)  # one number per tag name

    def run(texts: list[str]):
        for t in texts:
            text = main_text(t, sent.value)
            yield text, len(text)

    return score_partitions(pages, run, page, keep or [], "text string, n_chars bigint")
