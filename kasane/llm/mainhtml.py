"""Main text of web pages by line-block distribution.

A page is read once, tag by tag. What is not content by its element or by what it says of itself (scripts, styles, menus, headers,
footers, asides, adverts, notices, comments of readers) is stripped together with all other markup, which leaves lines:
one for each block of the page, in page order. For each line the lengths of the lines in a sliding window are summed,
text in links aside. Where the sums surge to ``SURGE`` a stretch of text begins, and it reaches to both sides as far as the sums
dive to nothing.

The stretch with the most text tells which element holds the article: the smallest one around its longer lines, or one further
up where other stretches of some weight stand. Headings right before it are its own. An ``article`` around it is such an element by its markup, and ``main`` where there
is none. All lines of that element are the main text, whatever stands before its first surge or behind its last dive. Where no element but the page itself
holds the stretches, the text goes from the first surge to the last dive, with the headings and paragraphs right beside.
Other articles, on the same page or within, are not part of it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasane.llm.textbytes import steps

#: Lines summed in one window.
WINDOW = 3
#: Characters in a window from which the text surges.
SURGE = 80
#: Part of the heaviest stretch's text that another stretch must have for their common element to count as the article's.
WEIGHT = 0.25
#: Part of all text that a form must hold to be a wrapper of the page instead of a form.
WRAPPER = 0.5

# Names of HTML elements by what they hold.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset("aside button canvas dialog footer head iframe menu nav noembed noframes noscript object option script select style svg template textarea title".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSED_BY = {"p": BLOCK, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset("html body main".split())
#: Words of a class, id or role that name what is not the article, and words that may stand beside them in the same label; any other word makes the label one of content.
ASIDES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments commentlist complementary contentinfo cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pagination pager popup promo promoted promotion recommended recommendations related reply replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
BESIDE = frozenset("alert area articles bar block body bottom box button buttons container content count fixed floating form global icons inner item items left link links list main media message mini mobile outer page policy post posts primary reader right secondary section site slot sticky stories sub text thread title top unit user wrap wrapper".split())

_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I) for name in RAW}
_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+)))?")
_QUOTE = re.compile("=\\s*[\"']|[\"']")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Line(NamedTuple):
    """A block: its text, characters of it in links, the innermost article (or -1), whether it stands in a form, and whether it is a heading or a paragraph."""

    text: str
    linked: int
    article: int
    form: bool
    heading: bool
    paragraph: bool


class Element(NamedTuple):
    """An open or closed element: its parent's place (or -1), its name and its first line."""

    parent: int
    name: str
    first: int


def _marks_aside(label: str, in_content: bool) -> bool:
    """Whether one class, id or role names something that is not the article: comment-list does, related-work and has-sidebar do not."""
    parts = {x.lower() for x in _PART.findall(label)}
    named = parts & ASIDES
    if not named or not parts <= ASIDES | BESIDE:
        return False
    return not in_content or named != {"header"}


def _is_aside(name: str, attributes: str, in_content: bool) -> bool:
    """Whether an element is not content by its name or by what it says of itself."""
    if name in SKIPPED:
        return True
    if name == "header" and not in_content:
        return True
    if not attributes or name in ROOTS:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
        if (key in ("class", "role") or (key == "id" and name != "p")) and name not in HEADINGS and any(_marks_aside(x, in_content) for x in value.split()):
            return True
    return False


def _tag_end(page: str, at: int) -> int:
    """Place of the > that ends the tag from ``at``, -1 if none does. A quote hides a >, unless no quote follows before the next tag."""
    end = page.find(">", at)
    while end >= 0:
        quote, inside = "", page[at:end]
        if "'" not in inside and not inside.count('"') & 1:
            return end
        for m in _QUOTE.finditer(inside):  # which quote, if any, is open at the >
            if quote and m[0][-1] == quote:
                quote = ""
            elif not quote and m[0][0] == "=":
                quote = m[0][-1]
        if not quote:
            return end
        tag = page.find("<", end)
        close = page.find(quote, end, tag if tag >= 0 else len(page))
        if close < 0:
            return end
        at, end = close + 1, page.find(">", close)
    return -1


class Page:
    """Lines and elements of a page, in one pass over its tags."""

    def __init__(self, page: str) -> None:
        self.lines: list[Line] = []
        self.elements: list[Element] = []
        self.last: list[int] = []  # of each element the line after its last one
        self._stack: list[tuple[str, int, bool]] = []  # name, place among the elements (or -1), whether skipped
        self._open: list[Counter] = [Counter()]  # names open in each scope; articles and the like begin a scope
        self._aside = self._link = self._form = self._content = 0  # elements of each kind around the current place
        self._articles = [-1]
        self._parts: list[str] = []
        self._linked = 0
        self._block = ""  # the block that the text at hand began in
        self._read(page)

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.lines.append(Line(text, self._linked, self._articles[-1], self._form > 0, self._block in HEADINGS, self._block == "p"))
        self._parts.clear()
        self._linked = 0
        self._block = ""

    def _push(self, name: str, aside: bool) -> None:
        place = -1
        if name in BLOCK:
            place = len(self.elements)
            parent = next((p for _, p, _ in reversed(self._stack[-2:]) if p >= 0), -1)
            self.elements.append(Element(parent, name, len(self.lines)))
            self.last.append(-1)
        self._open[-1][name] += 1
        self._stack.append((name, place, aside))
        self._count(name, aside, 1)
        if name == "article":
            self._articles.append(place)
        if name in ("article", "main", "body"):
            self._open.append(Counter())

    def _count(self, name: str, aside: bool, by: int) -> None:
        self._aside += by * aside
        self._link += by * (name == "a")
        self._form += by * (name == "form")
        self._content += by * (name in ("article", "main"))

    def _close(self, to: int) -> None:
        """Close the open elements from place ``to`` of the stack."""
        while len(self._stack) > to:
            name, place, aside = self._stack.pop()
            if name in ("article", "main", "body"):
                self._open.pop()
            if name == "article":
                self._articles.pop()
            self._open[-1][name] -= 1
            self._count(name, aside, -1)
            if place >= 0:
                self.last[place] = len(self.lines)

    def _end_tag(self, name: str) -> None:
        scope = name not in ("article", "main", "body", "html")
        if not (self._open[-1][name] if scope else any(x[name] for x in self._open)):
            return
        k = len(self._stack) - 1
        while self._stack[k][0] != name:
            k -= 1
        self._close(k)

    def _read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            to = page.find("<", at)
            to = n if to < 0 else to
            if to > at:
                self._text(page[at:to])
            if to == n:
                break
            at = self._markup(page, to)
        self._flush()
        self._close(0)

    def _text(self, raw: str) -> None:
        if self._aside:
            return
        text = html.unescape(raw)
        if self._link:
            self._linked += len(text.strip())
        self._parts.append(text)

    def _markup(self, page: str, at: int) -> int:
        """Read what begins with < at ``at``; the place after it."""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return end + 3 if end >= 0 else len(page)
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            return end + 3 if end >= 0 else len(page)
        if page[at + 1 : at + 2] in ("!", "?"):
            end = page.find(">", at)
            return end + 1 if end >= 0 else len(page)
        m = _NAME.match(page, at + 1)
        if not m:
            self._text("<")
            return at + 1
        end = _tag_end(page, m.end())
        if end < 0:  # a tag that never ends holds all the rest
            return len(page)
        name, attributes = m[1].lower(), page[m.end() : end]
        if name == "br" and not self._aside:
            self._parts.append(" ")
        if name in BLOCK:
            self._flush()
            self._block = name if page[at + 1] != "/" else ""
        if page[at + 1] == "/":
            self._end_tag(name)
        elif name in RAW:
            close = _RAW_END[name].search(page, end + 1)
            return close.end() if close else len(page)
        elif name not in VOID and not (attributes.rstrip().endswith("/") and name not in BLOCK):
            if name in BLOCK and len(self._stack) > 1 and self._stack[-1][0] == "a" and self._stack[-2][0] == "p":
                self._close(len(self._stack) - 1)
            while self._stack and name in CLOSED_BY.get(self._stack[-1][0], ()):
                self._close(len(self._stack) - 1)
            aside = _is_aside(name, attributes, self._content > 0)
            if name in BLOCK or name == "a" or aside:
                self._push(name, aside)
        return end + 1


def stretches(size: np.ndarray, window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, last + 1) of each stretch: from where the window sums surge, as far to both sides as they do not dive to nothing, without blank lines at its ends."""
    half = window // 2
    ends = np.concatenate([[0], np.cumsum(size)])
    i = np.arange(len(size))
    sums = ends[np.minimum(i + half + 1, len(size))] - ends[np.maximum(i - half, 0)]
    edges = np.diff(np.concatenate([[0], (sums > 0).astype(np.int8), [0]]))
    out = []
    for lo, hi in zip(np.flatnonzero(edges > 0).tolist(), np.flatnonzero(edges < 0).tolist(), strict=True):
        own = np.flatnonzero(size[lo:hi])
        if sums[lo:hi].max() >= surge:
            out.append((lo + int(own[0]), lo + int(own[-1]) + 1))
    return out


def main_lines(page: Page, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines of the article, as told at the head of this module. A page without a surge is its own text, lists of links aside."""
    lines, elements, last = page.lines, page.elements, page.last
    size = np.array([max(0, len(x.text) - x.linked) for x in lines], np.int64)
    form = np.array([x.form for x in lines], bool)
    used = np.ones(len(lines), bool)
    if size[form].sum() <= WRAPPER * size.sum():
        used = ~form
    size = size * used
    found = stretches(size, window, surge)
    if not found:
        return [x.text for x, n, ok in zip(lines, size, used, strict=True) if n or ok and x.paragraph]
    ends = np.concatenate([[0], np.cumsum(size)])
    weight = [int(ends[hi] - ends[lo]) for lo, hi in found]
    lo, hi = found[weight.index(max(weight))]
    heaviest = max(range(lo, hi), key=lambda i: size[i])
    article = lines[heaviest].article
    holder = -1
    if article >= 0:
        holder = article
        first, end = elements[article].first, last[article]
    else:
        around = [k for k in range(len(elements)) if elements[k].first <= heaviest < last[k]]  # from the outside in
        mains = [k for k in around if elements[k].name == "main"]
        full = [i for i in range(lo, hi) if 2 * size[i] >= min(surge, size[heaviest])]
        inner = [k for k in around if elements[k].first <= full[0] and full[-1] < last[k] and (elements[k].first, last[k]) != (heaviest, heaviest + 1)]
        holder = mains[-1] if mains else inner[-1] if inner else -1
        far = [x for x, w in zip(found, weight, strict=True) if w >= WEIGHT * max(weight)]
        for k in reversed(around):  # further up, where other stretches of weight stand
            if k < holder and elements[k].name not in ("html", "body") and not mains:
                inside = [x for x in far if elements[k].first <= x[0] and x[1] <= last[k]]
                if len(inside) > sum(elements[holder].first <= x[0] and x[1] <= last[holder] for x in far):
                    holder = k
        begin, stop = (elements[holder].first, last[holder]) if holder >= 0 else (0, len(lines))
        first, end = begin, stop
        if holder < 0 or elements[holder].name in ("html", "body"):  # nothing but the page itself holds the article: its stretches tell where it begins and ends
            mine = [x for x in found if x[0] < stop and x[1] > begin]
            first, end = max(begin, mine[0][0]), min(stop, mine[-1][1])
            while first and used[first - 1] and (lines[first - 1].heading or lines[first - 1].paragraph):
                first -= 1
            while end < stop and used[end] and lines[end].paragraph:
                end += 1
    return [x.text for i, x in enumerate(lines[first:end], first) if used[i] and x.article == article]


def main_text(page: str | None) -> str:
    """Main text of a page: blocks joined by one line feed, white space inside a block turned into one space."""
    return "\n".join(main_lines(Page(page or "")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text): one row per row of ``pages``, repeated rows each for itself.

    A null or text-free page has an empty text; an empty table gives an empty table; other columns are ignored. The time
    for a page grows with its length, however broken its markup is.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(work, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, text string")
