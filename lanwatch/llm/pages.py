"""Main text of web pages (operator 13).

1. The page streams through the standard library's HTML parser in pieces of ``FEED`` characters.  Its events build
   lines, one for each block of the page: text with character references decoded and white space made one space,
   the number of tags inside, the share of link text, and the open elements around it.
2. A line's text-to-tag ratio is its characters by its tags (one at least).  The ratios of the page, in page order, are
   smoothed by a Gaussian of ``SIGMA`` lines, and a threshold splits them in two clusters (two means, started
   at the extremes): lines above it are content seeds.  Where all ratios are alike, all lines are seeds.
3. Lines inside menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are
   known by their element, role, class or id; they take no part from the start.
4. The seeds choose the region: the ``article`` or ``main`` elements that hold a seed (the outermost of nested ones;
   all of them if none holds one).  On a page without these, the region is the deepest element that holds over three
   quarters of the seeds' characters, less its lines that are links alone.
5. All lines of the region are the text, joined by two line feeds: short paragraphs and headings of the article are
   kept, however low their ratio.

There is no shuffle; a page is whole in one task and leaves memory after its row.  Edge cases: null or empty html gives
an empty text; a page without any markup is one block; unclosed and stray tags, truncated pages and bytes that
are no known reference are read as the parser reads them; a very long page is streamed like any other; equal rows
get equal results; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .memory import give_back

FEED = 1 << 16             # characters given to the parser at once
SIGMA = 1.0                # lines
YIELD = 256                # pages in an Arrow batch of results

# fixed values: elements of HTML by their use
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# elements that the next one of the second list closes, if open in the same container
CLOSED_BY_SAME = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "option": "select", "tr": "table", "td": "tr table", "th": "tr table"}
SKIPPED = frozenset("""nav footer aside form script style noscript template iframe svg math object embed canvas audio video head title
    select textarea button datalist dialog menu search""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# words of class and id values
NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent
    gdpr notice notices notification alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar footer
    toolbar pagination pager comment comments disqus respond replies share sharing social newsletter subscribe
    signup login searchform related recommended""".split())
HEADERS = frozenset("header masthead".split())
# with one of these, a class tells of something elsewhere on the page
ABOUT = frozenset("has no with without is".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

IN, HEADER, OUT = 0, 1, 2      # state of an element: taken, taken for its headings alone, left out


def state_by_name(attrs: list[tuple[str, str | None]]) -> int:
    """What role, class, id or a hidden state say about an element."""
    state = IN
    for key, value in attrs:
        value = value or ""
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return OUT
        if key == "role" and value.strip().lower() in ROLES:
            return OUT
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return OUT
        if key in ("class", "id"):
            for name in value.split():
                words = {w.lower() for w in WORD.findall(name)}
                if words & ABOUT:
                    continue
                if words & NAMES:
                    return OUT
                if words & HEADERS:
                    state = HEADER
    return state


class Line:
    """A block's text in pieces, and what is known about it."""

    __slots__ = ("pieces", "tags", "linked", "around", "text")

    def __init__(self, around: tuple[int, ...]):
        self.pieces: list[str] = []
        self.tags = self.linked = 0
        self.around = around       # numbers of the open elements, outermost first
        self.text = ""


class Lines(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []        # open elements: tag, number, state
        self.number = 0
        self.links = self.tags = 0                         # open links; tags since the block began
        self.lines: list[Line] = []
        self.now: Line | None = None
        self.regions: set[int] = set()                     # numbers of article and main elements

    def _end_line(self) -> None:
        line, self.now = self.now, None
        if line is not None:
            line.tags = self.tags
            line.text = " ".join("".join(line.pieces).split())
            line.pieces = []
            if line.text:
                self.lines.append(line)
        self.tags = 0

    def _pop(self, at: int) -> None:
        for tag, _, _ in self.stack[at:]:
            self.links -= tag == "a"
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
            # a block ends an open paragraph, a list item the one before it
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == "p":
                    self._pop(i)
                    break
                if self.stack[i][0] in BLOCKS:
                    break
            if tag in CLOSED_BY_SAME:
                ends = CLOSED_BY_SAME[tag].split()
                same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i][0] in ends:
                        break
                    if self.stack[i][0] in same:
                        self._pop(i)
                        break
        else:
            self.tags += 1
            if tag == "br" and self.now is not None:
                self.now.pieces.append(" ")
        if tag in VOID:
            return
        outer = self.stack[-1][2] if self.stack else IN
        inside = any(n in self.regions for _, n, _ in self.stack)
        self.number += 1
        if tag in ("article", "main"):
            self.regions.add(self.number)
        if tag in SKIPPED:
            own = OUT
        elif tag in ("html", "body", "main") or (tag == "article" and not inside):
            own = IN
        else:
            own = max(state_by_name(attrs), HEADER if tag == "header" else IN)
        if own == HEADER and not inside:
            own = OUT                                      # the page's header; an article's holds its headings
        if tag in HEADINGS and outer == HEADER:
            outer = IN
        self.stack.append((tag, self.number, max(outer, own)))
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)                   # HTML has no self-closing elements but the void ones

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        else:
            self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if self.stack[i][0] in BLOCKS and tag not in BLOCKS:
                return                                     # an inline end tag closes nothing beyond its block

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][2] != IN:
            return
        if self.now is None:
            if not data.strip():
                return
            self.now = Line(tuple(n for _, n, _ in self.stack))
        self.now.pieces.append(data)
        if self.links:
            self.now.linked += len(data)

    def finish(self) -> None:
        if re.match(r"<[a-zA-Z/!?]", self.rawdata):        # the page ends inside a tag or comment
            self.rawdata = ""
        self.close()
        self._end_line()


def parse(html: str) -> tuple[list[Line], set[int]]:
    parser = Lines()
    for i in range(0, len(html), FEED):
        parser.feed(html[i:i + FEED])
    parser.finish()
    return parser.lines, parser.regions


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over neighbouring lines; at the ends, over the lines there are."""
    reach = min(int(3 * sigma + 0.5), len(ratios) - 1)
    if reach < 1:
        return ratios
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), weights, "full")[reach:reach + len(ratios)]
    return np.convolve(ratios, weights, "full")[reach:reach + len(ratios)] / inside


def threshold(ratios: np.ndarray) -> float:
    """Midpoint of the two clusters of two means in one dimension; from there up is content."""
    low, high = float(ratios.min()), float(ratios.max())
    if high - low <= 1e-9 * high:
        return low
    for _ in range(100):
        cut = (low + high) / 2
        above = ratios >= cut
        new = float(ratios[~above].mean()), float(ratios[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def seeds(lines: list[Line]) -> list[bool]:
    ratios = smoothed(np.array([len(x.text) / max(1, x.tags) for x in lines], np.float64))
    return (ratios >= threshold(ratios)).tolist()


def content(lines: list[Line], regions: set[int]) -> list[Line]:
    """Lines of the regions that the seeds choose."""
    if not lines:
        return []
    seed = seeds(lines)
    outermost = [next((n for n in x.around if n in regions), None) for x in lines]
    chosen = {n for n, s in zip(outermost, seed, strict=True) if s and n is not None} or {n for n in outermost if n is not None}
    if chosen:
        return [x for x, n in zip(lines, outermost, strict=True) if n in chosen]
    held: dict[int, int] = {}
    for x, s in zip(lines, seed, strict=True):
        if s:
            for n in x.around:
                held[n] = held.get(n, 0) + len(x.text)
    total = sum(len(x.text) for x, s in zip(lines, seed, strict=True) if s)
    # numbers rise in page order, so of nested elements the deepest has the greatest
    region = max((n for n, c in held.items() if 4 * c > 3 * total), default=None)
    inside = [x for x in lines if region is None or region in x.around]
    return [x for x in inside if x.linked < len(x.text)] or inside


def extract(html: str | None) -> str:
    lines, regions = parse(html or "")
    return "\n\n".join(x.text for x in content(lines, regions))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its number of code points."""
    C.for_python(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), YIELD):
                part = batch.slice(a, YIELD)
                texts = [extract(h.decode("utf-8", "replace")) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])
            give_back()

    # as bytes: a page that is no valid UTF-8 must not end the job
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
