"""Main text of web pages by tag-path ratios.

A page is read once, from left to right, as blocks of text, each under a
root-to-leaf path of tags and words (no numbers) of their class, id and role.  Per
path, text length and punctuation are summed and divided by the number of blocks;
the product of the roots of both ratios is the path's value.  Values are smoothed
over the tree of paths: a path is worth at least what its neighbours are, less a
share for every step between them.  Paths above a share of the page's best are
content.

What elements are called moves a value and decides nothing alone: a path through
a menu, page header, footer, sidebar or form, or an element named like an advert,
notice or comment, counts for a fraction; one in an article element for more; so
does, with a fraction, a path whose text is mostly links.  Only elements that hold
no running text (scripts, styles, buttons, hidden ones) are left out beforehand.

Blocks keep page order and are joined by a line feed; character references are
decoded, white space inside a block is one space.

Defined results: null or empty html gives an empty text; a page without
markup is one block; of paths with equal values all stay or all go; an empty table
gives no rows; unclosed, misnested and cut-off tags are closed where their
parent ends or the page does.  From the first tag that never ends, quotes no longer
hide a ``>``.  Time is linear in the page, whatever it holds.  Null and repeated ids
and extra columns do no harm.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_batches

#: A path is content from this share of the page's best value.
THRESHOLD = 0.5
#: What a step in the tree of paths leaves of a neighbour's value.
STEP = 0.75
#: Shares of a value that count: under an element of another purpose, under one
#: named so, under an article element, with nothing but links.
OTHER_TAG, OTHER_NAME, IN_ARTICLE, LINKS = 0.05, 0.1, 4.0, 0.05

# Fixed facts of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del",
          "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "body", "html", "article", "div", "section", "main"}
NO_TEXT = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas",
           "video", "audio", "button", "select", "textarea", "head", "title", "xmp", "noframes"}

# Elements that tend not to hold article text, by tag, and by a word of class, id or role.
OTHER = {"nav", "footer", "aside", "form", "dialog", "menu"}
NAMED = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "alert",
         "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo",
         "cookie", "cookies", "disclaimer", "dialog", "discussion", "footer", "gdpr", "menu",
         "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay",
         "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related",
         "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "skip", "social",
         "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget"}
# A name with one of these words says how the page is laid out ("no-sidebar").
NEUTRAL = {"article", "body", "content", "free", "has", "layout", "main", "no", "page", "post",
           "with", "without", "wrapper"}
ARTICLE = {"article", "main"}
# What holds the parts of one piece of text: no step in the tree.
HOLDERS = {"ul", "ol", "dl", "table", "thead", "tbody", "tr", "blockquote", "figure"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

OPENS = re.compile(r"<(?=[!?]|/?[A-Za-z])")
NAME = re.compile(r"(/?)([A-Za-z][^\s/><\"']*)")
QUOTED = re.compile(r"[>\"']")
CUT = re.compile(r"[^<>]*>?")
NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
MARKS = re.compile(r"[.,;:!?…。、，！？；：]")


class _Page:
    """The tree of paths of a page and its blocks: (path number, [(text, linked)])."""

    def __init__(self, html: str):
        self.parent, self.tag, self.weight = [0], [""], [1.0]      # of paths, the root first
        self.children: dict[tuple[int, str, float], int] = {}
        self.open: list[tuple[str, int, float]] = []               # tag, path, weight
        self.at: dict[str, list[int]] = defaultdict(list)          # places in open, by tag
        self.scopes: list[int] = []                                # of elements that p can't leave
        self.solid: list[int] = []                                 # of elements that aren't inline
        self.blocks: list[tuple[int, list[tuple[str, bool]]]] = []
        self.fresh = True
        self._read(html)

    def _path(self, parent: int, tag: str, label: str, weight: float) -> int:
        key = (parent, label, weight)
        if key not in self.children:
            self.children[key] = len(self.parent)
            self.parent.append(parent)
            self.tag.append(tag)
            self.weight.append(weight)
        return self.children[key]

    def _text(self, text: str) -> None:
        path = self.open[-1][1] if self.open else 0
        if self.fresh or self.blocks[-1][0] != path:               # or an inline part set apart
            if not text.strip():
                return
            self.blocks.append((path, []))
            self.fresh = False
        self.blocks[-1][1].append((text, bool(self.at["a"])))

    def _close(self, depth: int) -> None:
        if self.solid and self.solid[-1] >= depth:
            self.fresh = True
        while len(self.open) > depth:
            self.at[self.open.pop()[0]].pop()
        for places in (self.scopes, self.solid):
            while places and places[-1] >= depth:
                places.pop()

    def _last(self, tags: set[str]) -> int:
        return max((self.at[t][-1] for t in tags if self.at[t]), default=-1)

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br" and not self.fresh:
            self.blocks[-1][1].append((" ", False))
        if tag in VOID:
            self.fresh = self.fresh or tag == "hr"
            return
        if tag not in INLINE:
            self.fresh = True
            before = self._last({"p"} | CLOSES.get(tag, set()))
            if before > (self.scopes[-1] if self.scopes else -1):
                self._close(before)
        if tag == "body":
            self._close(1 if self.open and self.open[0][0] == "html" else 0)
        _, parent, weight = self.open[-1] if self.open else ("", 0, 1.0)
        names: set[str] = set()
        telling: set[str] = set()
        for m in NAMES.finditer(rest):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                words = set(WORDS.findall(name))
                names |= words
                telling |= words if not words & NEUTRAL else set()
        if tag not in {"html", "body", "main"}:
            if tag in NO_TEXT or "hidden" in rest.lower().split():
                weight = 0.0
            elif tag in OTHER or (tag == "header" and self._last(ARTICLE) < 0):
                weight = min(weight, OTHER_TAG)
            elif telling & NAMED:
                weight = min(weight, OTHER_NAME)
        if tag in ARTICLE and weight == 1.0:
            weight = IN_ARTICLE
        path = parent
        if tag not in INLINE:
            label = f"{tag}.{'.'.join(sorted(names))}"
            path = self._path(parent, tag, label, weight)
        elif weight != self.weight[parent]:
            path = self._path(parent, tag, tag, weight)
        depth = len(self.open)
        self.at[tag].append(depth)
        if tag in SCOPES:
            self.scopes.append(depth)
        if tag not in INLINE:
            self.solid.append(depth)
        self.open.append((tag, path, weight))

    def _end(self, tag: str) -> None:
        if not self.at[tag]:
            return
        depth = self.at[tag][-1]
        if tag not in INLINE or not self.solid or self.solid[-1] < depth:
            self._close(depth)

    def _read(self, html: str) -> None:
        at, quotes = 0, True
        while m := OPENS.search(html, at):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            if html[at] in "!?":
                mark = "-->" if html.startswith("!--", at) else ">"
                end = html.find(mark, at)
                at = len(html) if end < 0 else end + len(mark)
                continue
            name = NAME.match(html, at)
            at = name.end()
            end = _tag_end(html, at) if quotes else -1
            if end < 0:
                quotes = False
                end = CUT.match(html, at).end()
                if html[end - 1] != ">":                           # cut off: no tag at all
                    at = end
                    continue
                end -= 1
            rest, at = html[at:end], end + 1
            tag = name[2].lower()
            if name[1]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = close.start() if close else len(html)
                self.fresh = True
            else:
                self._start(tag, rest)
        self._text(html[at:])


def _tag_end(html: str, at: int) -> int:
    """Where the ``>`` of a tag stands that is in no quotes; -1 if nowhere."""
    while m := QUOTED.search(html, at):
        if m[0] == ">":
            return m.start()
        at = html.find(m[0], m.end()) + 1
        if not at:
            return -1
    return -1


def path_values(page: _Page, texts: list[str]) -> list[float]:
    """The smoothed and fused value of every path of ``page``."""
    n = len(page.parent)
    size, marks, linked, count = [0] * n, [0] * n, [0] * n, [0] * n
    for (path, parts), text in zip(page.blocks, texts):
        if text:
            size[path] += len(text)
            marks[path] += len(MARKS.findall(text))
            linked[path] += sum(len(x.strip()) for x, link in parts if link)
            count[path] += 1
    free, own = [1.0] * n, [0.0] * n
    for p in range(n):
        if count[p]:
            if page.tag[p] not in HEADINGS:
                free[p] = min(1.0, max(LINKS, 2 * (1 - linked[p] / size[p])))
            own[p] = math.sqrt(size[p] / count[p]) * (0.5 + math.sqrt(marks[p] / count[p]))
    step = [1.0 if t in HOLDERS else STEP for t in page.tag]
    part = [min(1.0, w) for w in page.weight]
    near = [own[p] * free[p] * part[p] for p in range(n)]
    for p in range(n - 1, 0, -1):                                  # children come after parents
        near[page.parent[p]] = max(near[page.parent[p]], near[p] * step[p])
    for p in range(1, n):                                          # a share less further inside
        up = page.parent[p]
        if part[up]:
            near[p] = max(near[p], near[up] * step[p] * part[p] / part[up])
    return [max(own[p] * part[p], near[p]) * free[p] * max(1.0, page.weight[p]) if count[p]
            else 0.0 for p in range(n)]


def content(html: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of one page."""
    page = _Page(html or "")
    texts = [" ".join(unescape("".join(x for x, _ in parts)).split()) if page.weight[path] else ""
             for path, parts in page.blocks]
    value = path_values(page, texts)
    least = threshold * max(value)
    return "\n".join(t for (path, _), t in zip(page.blocks, texts) if t and value[path] >= least)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``_hx_text``."""
    columns = [c for c in pages.columns if c != html_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [content(h) for h in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(text, pa.string())],
                names=[*columns, "_hx_text"])

    schema = pages.select(*columns).schema.add("_hx_text", "string")
    return map_batches(pages.select(*columns, F.col(html_col)), run, schema)
