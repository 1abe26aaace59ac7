"""Main text of web pages from parser events, by text-to-tag ratios.

The standard library's streaming parser turns a page into lines, one per block
element.  Each line has its text, the number of tags it took, and whether it stands in
a part of the page that is not content (a menu, a form, a comment, ...).  The ratio of
characters to tags, zero for such parts and for lines that are mostly links, is smoothed
along the page by a Gaussian; lines above a threshold (the spread of the smoothed
ratios) form the core.  Regions are selected by their core and are then kept whole, so
short paragraphs and headings inside them stay.

A region is a stretch of lines between parts that are no content.  On a page with an
article or main element, it is the lines of one container (a div, an article, ...);
sections belong to the container around them, and containers of nothing but list items,
cells, preformatted text and their headings share the state of the lines before them.
These elements are a prior, they decide nothing alone: ratios in them weigh ``PRIOR`` times.
A region is selected if it holds a core line that reaches the threshold by its own ratio
too, or the highest smoothed ratio.  If some region of an element is selected so, others in
it are too if half of their lines are core, though only neighbours lift them, or if they
hold nothing but headings and the next one is selected.  Mostly links: outside such an
element one line is a menu; inside it two in a row are a link list, unless a heading of
the text comes right before them ("References"), and a single one belongs to the text.

Marks: a class, id or role drops its element if it is a mark, ends with one
("post-comments") or goes on after it with words of frames alone ("ad-container").  Any
other name that holds a mark ("social-science-article", all widgets), phrases
("notice-and-consent") and, in an article, ids, which generators make of heading texts,
only make a suspect, on any page: it goes if it has no core line, is mostly links, or has
neither a heading nor a line of ``PROSE`` characters per tag.  If a page would be empty,
names of several words make suspects only.  Within a line only marks of ``INLINE`` leave
text out, and none in preformatted text.

Pages are mapped row by row in Arrow batches: no shuffle, memory of one batch.

Edge cases: NULL and empty html give an empty text, and so does a page with menus
only; broken or cut off markup is read as far as it goes; repeated rows give equal
texts; columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol p pre section summary table tbody tfoot thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that never hold content.
DROPPED = frozenset(
    "annotation applet aside audio button canvas datalist dialog embed footer form head iframe "
    "input map menu meter nav noscript optgroup option progress script select style svg "
    "template textarea title video".split()
)
#: Words in class, id or role that mark a part as no content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs "
    "comment commentlist comments complementary consent contentinfo cookie cookies "
    "copyright dialog disqus footer gdpr login menu modal nav navbar navigation newsletter notice "
    "pager pagination paywall popup promo promoted promotion recommendations recommended "
    "related replies reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription tags toolbar warning".split()
)
#: Words that hint at a part of a page, whatever it is.
HINTS = frozenset("widget widgets".split())
#: Marks that leave out text within a line.
INLINE = frozenset(
    "ad ads adv advert adverts advertisement advertising cookie cookies newsletter popup promo "
    "promoted share sharing sponsored".split()
)
#: Words of frames: after a mark they leave it one ("comment-body").
FRAMES = frozenset(
    "area articles author bar block body bottom box button buttons col column container content date "
    "entries footer form group head header heading holder icons inner item items left link links "
    "list lists meta news outer panel posts right row section slot stories strip text thread "
    "threads title top topics unit widget widgets wrap wrapper zone".split()
)
#: A heading with one of these words is none of the text.
OTHER_HEADINGS = frozenset(
    "advertisement comments latest more newsletter popular recommended related share sponsored "
    "subscribe tags trending".split()
)
#: Marks of a page's head part; inside an article they may hold its title.
HEAD_MARKS = frozenset("header masthead".split())
#: After these, a mark describes a frame around the content ("with-sidebar").
NEGATED = frozenset("has no with without".split())
#: So it does between one of these and a word of ``WRAPS`` ("content-sidebar-wrap"), and
#: a sidebar or header does after one of these alone ("main-sidebar", "post-header").
LAYOUT = frozenset("article body content layout main page post site".split())
WRAPS = frozenset("container layout row wrap wrapper".split())
COLUMNS = frozenset("header masthead sidebar".split())
#: Words of phrases, as in a heading.
PHRASES = frozenset("a an and for in of on or the to vs".split())
#: A mark and a state tell how a frame is set ("comments-open").
STATES = frozenset("closed disabled enabled none off on open".split())
ROOTS = frozenset(["article", "main"])
CONTAINERS = frozenset("article body center div main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Lines in these share the state of the lines before them.
LISTED = frozenset("dd dt li pre td th tr".split())
FIXED_TEXT = frozenset(["code", "pre"])
#: A tag that the end of the page cuts off.
CUT_OFF = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
_PARTS = re.compile(r"[^a-z0-9]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

SIGMA = 1.0
RADIUS = 3
#: Characters per tag of a line that reads as prose.
PROSE = 15.0
#: Weight of ratios in an article or main element.
PRIOR = 2.0


NO_MARK, HINT, MARK = 0, 1, 2


def mark_of(name: str, marks: frozenset[str] = MARKS) -> int:
    """What one class, id or role says: nothing, a hint, or that its element is no content."""
    words = [w for w in _PARTS.split(name) if w]
    at = next((k for k, w in enumerate(words) if w in marks or w in HINTS), None)
    if at is None:
        return NO_MARK
    before = words[:at]
    if NEGATED & set(before) or words[-1] in STATES:
        return NO_MARK
    if LAYOUT & set(before) and (words[at] in COLUMNS or words[-1] in WRAPS):
        return NO_MARK
    if words[at] in HINTS or PHRASES & set(words):
        return HINT
    ends = words[-1] in marks or all(w in FRAMES or w in marks or w.isdigit() for w in words[at + 1 :])
    return MARK if ends else HINT


class Line(NamedTuple):
    text: str
    tags: int
    chrome: bool
    root: int  # number of the outermost article or main element, 0 outside
    link_chars: int
    container: int
    heading: bool
    listed: bool


class Open(NamedTuple):
    """An element that is not closed yet."""

    tag: str
    chrome: bool
    root: bool
    suspect: int  # its number, or -1


class Lines(HTMLParser):
    """Collects the lines of a page.  ``lenient``: names of several words are hints only."""

    def __init__(self, lenient: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.lenient = lenient
        self.lines: list[Line] = []
        self.stack: list[Open] = []
        self.places: dict[str, list[int]] = {}  # where in the stack each tag stands
        self.block_places: list[int] = []
        self.chrome = self.muted = self.article = self.links = self.headings = self.listed = self.fixed = 0
        self.containers = [0]  # numbers of the open ones
        self.n_containers = self.root = 0
        self.suspects: list[list[int]] = []  # the lines of each: from, up to
        self.parts: list[str] = []
        self.tags = self.link_chars = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(
                Line(
                    text, self.tags, self.chrome > 0, self.root if self.article else 0,
                    self.link_chars, self.containers[-1], self.headings > 0, self.listed > 0,
                )
            )
            self.tags = 0
        self.parts, self.link_chars = [], 0

    def finish(self) -> None:
        self.close()
        self.end_line()
        for element in self.stack:
            if element.suspect >= 0:
                self.suspects[element.suspect][1] = len(self.lines)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            if self.places.get("p") and self.places["p"][-1] == self.block_places[-1]:
                self._pop("p")  # a block ends an open paragraph, but not one around another block
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag in VOID:
            return
        root = tag in ROOTS
        chrome, suspect = self._judge(tag, attrs)
        if suspect:
            self.suspects.append([len(self.lines), len(self.lines)])
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.block_places.append(len(self.stack))
        self.stack.append(Open(tag, chrome, root, len(self.suspects) - 1 if suspect else -1))
        self._count(self.stack[-1], 1)
        if tag in CONTAINERS:
            self.n_containers += 1
            self.containers.append(self.n_containers)
            if root and self.article == 1:
                self.root = self.n_containers

    def _count(self, element: Open, by: int) -> None:
        tag = element.tag
        # A block of this kind is a line of its own; within a line, text is left out.
        if tag in BLOCKS:
            self.chrome += by * element.chrome
        else:
            self.muted += by * element.chrome
        self.article += by * element.root
        self.links += by * (tag == "a")
        self.headings += by * (tag in HEADINGS)
        self.listed += by * (tag in LISTED)
        self.fixed += by * (tag in FIXED_TEXT)

    def _judge(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether an element is no content for certain, and whether it is a suspect."""
        if tag in DROPPED or (tag == "header" and not self.article):
            return True, False
        if tag in ROOTS or tag in ("html", "body"):
            return False, False
        block, suspect = tag in BLOCKS, False
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                if name == "id" and tag in HEADINGS:
                    continue
                for word in value.lower().split():
                    if block:
                        found = mark_of(word)
                        if found < MARK and not self.article:
                            found = max(found, mark_of(word, HEAD_MARKS))
                        weak = (name == "id" and self.article) or (self.lenient and not word.isalnum())
                        if found == MARK and not weak:
                            return True, False
                        suspect |= found > NO_MARK
                    elif name != "id" and not self.fixed and mark_of(word, INLINE) == MARK:
                        return True, False
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, False
            elif name == "style" and value and _UNSEEN.search(value):
                return True, False
        return False, suspect

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if not self.places.get(tag):
            return
        # A paragraph does not reach out of the block that holds it.
        if tag != "p" or self.places["p"][-1] == self.block_places[-1]:
            self._pop(tag)

    def _pop(self, tag: str) -> None:
        """Close an open element and all that was opened in it."""
        while True:
            element = self.stack.pop()
            name = element.tag
            if name in BLOCKS:
                self.block_places.pop()
                if element.chrome or element.suspect >= 0:
                    self.end_line()
            if element.suspect >= 0:
                self.suspects[element.suspect][1] = len(self.lines)
            self.places[name].pop()
            self._count(element, -1)
            if name in CONTAINERS:
                self.containers.pop()
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        if self.muted:
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data)


def smooth(ratios: np.ndarray) -> np.ndarray:
    """A Gaussian over neighbouring lines; the ends are weighted by what is there."""
    reach = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)] / weight


def link_lists(lines: list[Line], links: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The lines of articles that are mostly links and stand in a row, but for rows that
    follow a heading of the text."""
    out = links & (root > 0)
    beside = np.zeros(len(out) + 2, dtype=bool)
    beside[:-2] |= out
    beside[2:] |= out
    out &= beside[1:-1]
    first = np.flatnonzero(out & ~np.append(False, out[:-1]))
    for k in first.tolist():
        before = lines[k - 1] if k else None
        if before is not None and before.heading and root[k - 1] == root[k]:
            if not OTHER_HEADINGS & set(_PARTS.split(before.text.lower())):
                while k < len(out) and out[k]:
                    out[k] = False
                    k += 1
    return out


class Measured(NamedTuple):
    chrome: np.ndarray  # with lines of menus
    root: np.ndarray
    ratios: np.ndarray
    smoothed: np.ndarray
    threshold: float
    core: np.ndarray


def measure(lines: list[Line], chrome: np.ndarray) -> Measured:
    root = np.where(chrome, 0, [line.root for line in lines])
    article = root > 0
    links = np.array([2 * line.link_chars > len(line.text) for line in lines]) & ~chrome
    chrome = chrome | (links & ~article) | link_lists(lines, links, root)
    skipped = chrome | links
    ratios = np.array([0.0 if skip else len(x.text) / max(x.tags, 1) for x, skip in zip(lines, skipped, strict=True)])
    ratios[article] *= PRIOR
    smoothed = smooth(ratios)
    threshold = min(smoothed.std(), smoothed.max())
    core = (smoothed >= threshold) & ~chrome & (smoothed > 0)
    return Measured(chrome, root, ratios, smoothed, threshold, core)


def convicted(lines: list[Line], suspects: list[list[int]], page: Measured) -> np.ndarray:
    """The lines of suspects that do not look like text.  Each has a stretch of lines."""
    first, stop = np.array(suspects).T

    def total(values: list | np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(np.asarray(values, dtype=np.int64)))
        return sums[stop] - sums[first]

    prose = total([x.heading or len(x.text) >= PROSE * x.tags for x in lines]) > 0
    linked = 2 * total([x.link_chars for x in lines]) > total([len(x.text) for x in lines])
    guilty = linked | ~prose | (total(page.core) == 0)
    depth = np.zeros(len(lines) + 1, dtype=np.int64)
    np.add.at(depth, first[guilty], 1)
    np.subtract.at(depth, stop[guilty], 1)
    return np.cumsum(depth)[:-1] > 0


def shared_states(lines: list[Line], region: np.ndarray, root: np.ndarray, chrome: np.ndarray) -> np.ndarray:
    """Regions, where those of lists alone are that of the line before (or after) them in
    the same element."""
    n = region.max() + 1
    listed = np.array([line.listed for line in lines])
    heading = np.array([line.heading for line in lines])
    alone = (np.bincount(region, ~chrome & listed, n) > 0) & (np.bincount(region, ~chrome & ~listed & ~heading, n) == 0)
    mine = alone[region] & (root > 0)
    if not mine.any():
        return region
    out = region.copy()
    for order in (range(len(lines)), range(len(lines) - 1, -1, -1)):
        last: dict[int, int] = {}
        for k in order:
            if chrome[k] or not root[k]:
                continue
            if not mine[k]:
                last[root[k]] = region[k]
            elif root[k] in last and out[k] == region[k]:
                out[k] = last[root[k]]
    return out


def selected_text(parser: Lines) -> str:
    """The lines of the selected regions, joined by an empty line."""
    lines = parser.lines
    if not lines:
        return ""
    marked = np.array([line.chrome for line in lines])
    page = measure(lines, marked)
    if parser.suspects:
        page = measure(lines, marked | convicted(lines, parser.suspects, page))
    chrome, root, ratios, smoothed, threshold, core = page
    article = root > 0
    region = np.cumsum(chrome)
    if not article.any():
        kept = ~chrome & np.isin(region, region[core])
    else:
        # A part that is no content does not cut a container of an article in two.
        keys = np.stack([[line.container for line in lines], np.where(article, -1, region)], axis=1)
        region = np.unique(keys, axis=0, return_inverse=True)[1].ravel()
        own = core & ((ratios >= threshold) | (smoothed == smoothed[~chrome].max(initial=0.0)))
        selected = np.bincount(region, own) > 0
        inside = article & ~chrome & np.isin(root, root[own & article])
        lines_of, heads_of = np.bincount(region, ~chrome), np.bincount(region, ~chrome & [x.heading for x in lines])
        selected |= (2 * np.bincount(region, core & inside) >= lines_of) & (np.bincount(region, inside) > 0)
        after = -1
        for k in np.flatnonzero(inside)[::-1]:  # from the end, for several in a row
            r = region[k]
            selected[r] |= after >= 0 and bool(selected[after]) and heads_of[r] == lines_of[r]
            after = r
        # A list that is selected by itself stays; others follow their surroundings.
        kept = ~chrome & (selected[region] | selected[shared_states(lines, region, root, chrome)])
    return "\n\n".join(line.text for line, keep in zip(lines, kept, strict=True) if keep)


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = CUT_OFF.sub("", html)
    for lenient in (False, True):
        parser = Lines(lenient)
        parser.feed(page)
        parser.finish()
        text = selected_text(parser)
        if text or not any(line.chrome for line in parser.lines):
            break
    return text


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    schema = T.StructType(
        [
            *[pages.schema[c] for c in kept],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(html) for html in batch[html_col]]
            yield batch[kept].assign(text=texts, n_chars=[len(t) for t in texts])

    return pages.mapInPandas(over, schema)
