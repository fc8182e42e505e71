"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams tags and text; a page becomes lines, one for each block with text. A line's ratio is its
characters per tag, taken as a logarithm. Ratios are smoothed with a Gaussian along the page, and two means cluster them: the threshold is midway.
A line's weight is how far it is above or below the threshold, times its characters and some more. The block whose lines have the largest sum of
weights is the region, of equal ones the deepest: it takes short lines along if they are cheap for what they lie between, and leaves out what only costs. A paragraph
or another piece gives way to the block around it where that has half as much or more. Where the region is the whole page, it goes from the first to the last content line,
without lines that are mostly links. All lines of the region make the text, as the contract drops nothing inside.

Lines in elements that are no content by their name, role or state (menus, forms, adverts, hidden ones, ...) are vetoed, and so are those in blocks
whose class or id says so (comments, sidebars, ...), but for blocks that such a word only describes, like a layout with a sidebar: a block with half
of the page's characters and all of its articles and main headings is no noise, and where all lines would go, the largest such block stays.

Elements are intervals of lines with a pointer to their parent, and open ones are found by name, so that the time is in proportion to the page however deep it nests.

Edge cases: null and empty pages give an empty text; a page without tags is one block; elements left open end with their parent or
the page; text is never cut, whatever its length (a task holds one page and some 20 times its bytes). Repeated rows get a row each, an
empty table gives an empty result, and other columns are kept whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SIGMA, LINKS = 1.5, 0.6
#: Characters that a line's weight counts besides its own; what the block around a piece has at least of its weight.
BASE, NEARLY = 5, 0.5

# Names in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul caption title".split()
)
SKIP = set("script style noscript template head title nav footer aside form button select textarea iframe object embed svg math canvas audio video map menu dialog".split())
ROOTS = {"html", "body", "main", "article"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = {"ul": {"li"}, "ol": {"li"}, "dl": {"dt", "dd"}, "table": {"tr", "td", "th"}}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar tooltip".split())
NOISE = set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs "
    "pagination pager footer foot sidebar aside widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login signin register comment comments commentlist respond reply replies disqus share sharing social related recommended trending toolbar "
    "skip hidden".split()
)
NOISE_ARTICLES = {"comment", "reply", "ad", "advert", "promo", "sponsored", "related"}
PIECES = set("p li ul ol blockquote pre h1 h2 h3 h4 h5 h6 table tbody tr figure dl dd".split())
HEADS = {"header", "head", "masthead", "topbar", "top-bar"}
_TOKEN = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


class Lines(HTMLParser):
    """Lines of a page and its elements, numbered as they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, characters in links, innermost open block
        self.kinds: list[str] = []  # of each element: its name
        self.above: list[int] = []  # the block that it is in
        self.first: list[int] = []  # its first line
        self.end: list[int] = []  # the line after its last
        self.last: list[int] = []  # its last descendant
        self.soft: list[int] = []  # the innermost block, itself included, that its class or id calls noise
        self.marks: list[int] = []  # articles, main elements and main headings
        self.stack: list[int] = []
        self.noise: list[bool] = []  # of each element on the stack
        self.open: dict[str, list[int]] = {}  # places on the stack by name
        self.blocks: list[int] = []  # places of blocks
        self.parts: list[str] = []
        self.tags = self.linked = self.dropped = 0

    def _nearest(self, names) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text or self.dropped:
            self.lines.append((text, self.tags, self.linked, self.stack[self.blocks[-1]] if self.blocks else -1))
            self.tags = 0
        self.parts, self.linked, self.dropped = [], 0, 0

    def _push(self, tag: str, noise: bool, soft: bool) -> None:
        number, block = len(self.kinds), tag in BLOCK
        above = self.stack[self.blocks[-1]] if self.blocks else -1
        around = self.soft[self.stack[-1]] if self.stack else -1
        if tag in ("article", "main", "h1") and not noise and not soft:
            self.marks.append(number)
        for held, value in ((self.kinds, tag), (self.above, above), (self.first, len(self.lines)), (self.end, -1), (self.last, number), (self.soft, number if soft else around)):
            held.append(value)
        self.open.setdefault(tag, []).append(len(self.stack))
        if block:
            self.blocks.append(len(self.stack))
        self.stack.append(number)
        self.noise.append(noise)

    def _pop(self, at: int) -> None:
        if self.blocks and self.blocks[-1] >= at:
            self.flush()
        while len(self.stack) > at:
            number = self.stack.pop()
            self.noise.pop()
            self.open[self.kinds[number]].pop()
            if self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()
            self.end[number], self.last[number] = len(self.lines), len(self.kinds) - 1

    def finish(self) -> None:
        self.close()
        self.flush()
        self._pop(0)

    def _close_implied(self, tag: str) -> None:
        if tag in CLOSES:
            at = self._nearest(CLOSES[tag])
            if at > self._nearest(n for n in SCOPE if SCOPE[n] & CLOSES[tag]):
                self._pop(at)
        elif tag in BLOCK and self.blocks and self.kinds[self.stack[self.blocks[-1]]] == "p":
            self._pop(self.blocks[-1])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK or tag in ("td", "th"):
            self._close_implied(tag)
        if tag in BLOCK:
            self.flush()
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag not in VOID:
            noise, soft = self._is_noise(tag, attrs)
            self._push(tag, noise or bool(self.noise) and self.noise[-1], soft)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML has no self-closing elements but the void ones

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        at = self._nearest([tag])
        if at >= 0 and (tag in ROOTS or at >= self._nearest(("article", "main", "body"))):
            self._pop(at)
        elif at < 0 and tag == "p":
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.noise and self.noise[-1]:  # a line of noise alone counts in the smoothing; inside a line, noise is left out
            self.dropped += not data.isspace()
            return
        self.parts.append(data)
        # a link counts however deep the text is in it, but not beyond the block around its own block, as it may never be closed
        if self.open.get("a") and self.open["a"][-1] > (self.blocks[-2] if len(self.blocks) > 1 else -1):
            self.linked += len(data)

    def _is_noise(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether an element is noise for certain, and whether it is a block that its class or id calls so."""
        if tag in SKIP:
            return True, False
        inside = bool(self.open.get("article") or self.open.get("main"))
        if tag == "header":
            return not inside, False
        soft = False
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return tag not in ROOTS, False
            if not value:
                continue
            if key == "role" and value.lower() in ROLES and tag not in ("html", "body", "main"):
                return True, False
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, False
            if key in ("class", "id") and tag not in ("html", "body", "main"):
                tokens = {t.lower() for t in _TOKEN.findall(value)}
                if tokens & HEADS and not inside:
                    return True, False
                soft = soft or bool(tokens & (NOISE if tag != "article" else NOISE_ARTICLES))
        return (False, True) if soft and tag in BLOCK else (soft, False)


def _vetoed(page: Lines, size: np.ndarray) -> np.ndarray:
    """For each line, whether it is noise."""
    none = size == 0
    around = [page.soft[x[3]] if x[3] >= 0 else -1 for x in page.lines]
    if max(around, default=-1) < 0:
        return none
    total = np.concatenate(([0.0], np.cumsum(size)))
    held = {e: total[page.end[e]] - total[page.first[e]] for e in set(page.soft) - {-1}}
    marks, noisy = page.marks, {-1: False}
    for e in sorted(held):  # what is outside comes first
        inside = bisect_right(marks, page.last[e]) - bisect_right(marks, e)
        layout = inside == len(marks) > 0 and 2 * held[e] >= total[-1]
        outer = page.soft[page.above[e]] if page.above[e] >= 0 else -1
        noisy[e] = not layout or noisy[outer]
    veto = none | np.array([noisy[e] for e in around])
    if veto.all() and held:
        most = max(held, key=lambda e: (held[e], -e))
        veto = none | np.array([e != most for e in around])
    return veto


def smoothed(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    held = np.convolve(np.ones(len(x)), kernel, "same") if len(x) > 2 * reach else None
    if held is None:
        padded = np.concatenate((np.zeros(reach), x, np.zeros(reach)))
        ones = np.concatenate((np.zeros(reach), np.ones(len(x)), np.zeros(reach)))
        return np.convolve(padded, kernel, "valid") / np.convolve(ones, kernel, "valid")
    return np.convolve(x, kernel, "same") / held


def midway(x: np.ndarray) -> float:
    """Midway between the two means that cluster x best, from its ends on."""
    low, high = float(x.min()), float(x.max())
    for _ in range(32):
        below = x < (low + high) / 2
        if not below.any():
            break
        before, low, high = (low, high), float(x[below].mean()), float(x[~below].mean())
        if before == (low, high):
            break
    return (low + high) / 2


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    lines = page.lines
    size = np.array([len(x[0]) for x in lines], float)
    noise = _vetoed(page, size)
    if noise.all():
        return ""
    smooth = smoothed(np.log1p(np.where(noise, 0.0, size / np.maximum([x[1] for x in lines], 1))))
    threshold = midway(smooth)
    total = np.concatenate(([0.0], np.cumsum((smooth - threshold) * (size + BASE))))
    weight = lambda e: total[page.end[e]] - total[page.first[e]] if e >= 0 else total[-1]
    # elements are numbered in page order, so of equal ones the last is the deepest; -1 is the page
    region, most = -1, total[-1]
    for e in range(len(page.kinds)):
        if page.kinds[e] in BLOCK and weight(e) >= most - 1e-9 * abs(most):
            region, most = e, weight(e)
    while region >= 0 and page.kinds[region] in PIECES and weight(page.above[region]) >= NEARLY * most:
        region = page.above[region]
    first, end = (page.first[region], page.end[region]) if region >= 0 else (0, len(lines))
    chosen = [i for i in range(first, end) if not noise[i]]
    content = ~noise & (smooth >= threshold)
    if (region < 0 or page.kinds[region] in ("body", "html")) and content.any():
        first, last = np.nonzero(content)[0][[0, -1]]
        while first > 0 and not noise[first - 1] and lines[first - 1][3] >= 0 and page.kinds[lines[first - 1][3]] in ("h1", "h2", "h3"):
            first -= 1
        chosen = [i for i in chosen if first <= i <= last and lines[i][2] <= LINKS * size[i]]
    return "\n".join(lines[i][0] for i in chosen)


def extracted(pages: DataFrame, html: str = "html", name: str = "__text") -> DataFrame:
    """pages without the html, with the text in a column of this name, which replaces one that pages has."""
    carried = [c for c in pages.columns if c not in (html, name)]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col(f"`{html}`").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.record_batch([part.column("row"), pa.array([main_text(x.as_py()) for x in part.column("html")], pa.string())], ["row", "text"])

    found = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in carried], F.col("text").alias(name))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


QUERIES = {"op7_html_text": op7_html_text}
ORACLE: dict[str, str] = {}
