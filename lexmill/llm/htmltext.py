"""HTML extraction: parser events, text-to-tag ratios by line, Gaussian smoothing and threshold clustering.

The standard library's streaming parser gives events; block elements cut the page into lines, each with its text, the
number of tags on it, the letters of it that are links, and its element. The ratio of characters to tags is smoothed over
all lines of the page with a Gaussian kernel and split in two clusters by a threshold (the deviation of the smoothed
ratios). Lines inside menus, headers, footers, sidebars, notices, adverts, forms, comments and the like are noise by their
elements; the lines of the upper cluster that are not are the seeds of the content, and without seeds there is none.

The content region is the innermost element that holds nearly all text of the seeds. In an article it is that article, and
around articles it is those with seeds, or else the main part: all lines that are not noise are the text, so that short
paragraphs of an article stay. On pages without either it runs from the first seed to the last and on in both directions, as
long as lines are more text than links, with a heading that stands right before it.

Null and empty pages have no text; a page without tags is one line. Damaged markup is read as browsers do, as far as the
parser can; a reference cut off at the end of a page stays as it is. Work and memory are linear in a page's length and
depth. Ties in a ratio do not matter, as all lines at the threshold are seeds. Repeated rows are each extracted, extra
columns may have any name, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm.common import small_batches

# Element and class names of HTML pages.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title iframe object svg math canvas audio video select button textarea datalist noframes map".split())
NOISE = frozenset("nav footer aside form menu dialog search".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup"}
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup signin login paywall sidebar sidebars aside menu menus nav navbar navigation navlinks breadcrumb breadcrumbs pagination pager topbar toolbar masthead footer footers "
    "comment comments commentlist disqus respond replies related recommended recommendations share sharing social toc skip search widget widgets copyright".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
ROOTS = frozenset("html body main".split())
_WORD = re.compile(r"[a-z]+")


@dataclass
class Open:
    """An open element."""

    tag: str
    number: int
    noise: bool = False
    silent: bool = False
    inside: bool = False  # an article or the main part


@dataclass
class Line:
    parts: list[str] = field(default_factory=list)
    element: int = 0
    noise: bool = False
    tags: int = 0
    linked: int = 0
    text: str = ""


def _is_noise(tag: str, attrs: list, inside_article: bool) -> bool:
    given = dict(attrs)
    if tag not in ROOTS and ("hidden" in given or (given.get("aria-hidden") or "") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style") or "")):
        return True
    if tag in NOISE or tag == "header" and not inside_article:
        return True
    if tag in ROOTS:
        return False
    if (given.get("role") or "").lower() in NOISE_ROLES:
        return True
    words = set(_WORD.findall(f"{given.get('class') or ''} {given.get('id') or ''}".lower()))
    if tag == "article":
        return bool(words & {"comment", "comments"})
    return bool(words & NOISE_WORDS) or "header" in words and not inside_article


class PageReader(HTMLParser):
    """Cuts the event stream into lines. Elements are numbered as they open, so those inside one have the numbers up to its last."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.last = [""], [0], [0]
        self.open = [Open("", 0)]
        self.places: dict[str, list[int]] = {}  # of each tag, its places in ``open``
        self.blocks: list[int] = []  # places of block elements
        self.lines: list[Line] = []
        self.line = Line()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![`` begins a comment up to the next ``>``, whatever follows."""
        return self.parse_bogus_comment(i)

    def parse_html_declaration(self, i: int) -> int:
        """One that does not end takes the rest of the page, which is fed as a whole."""
        to = super().parse_html_declaration(i)
        return to if to >= 0 else len(self.rawdata)

    def _end_line(self) -> None:
        if self.line.parts:
            self.line.text = " ".join("".join(self.line.parts).split())
            if self.line.text:
                self.lines.append(self.line)
        self.line = Line(element=self.open[-1].number, noise=self.open[-1].noise)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.line.tags += 1
        if (tag == "p" or tag in ENDS_PARAGRAPH) and self.blocks and self.open[self.blocks[-1]].tag == "p":
            self._pop_to(self.blocks[-1])
        if tag == "li":
            self._close_implied(("li",), ("ul", "ol", "menu"))
        elif tag in ("dt", "dd"):
            self._close_implied(("dt", "dd"), ("dl",))
        elif tag in ("td", "th"):
            self._close_implied(("td", "th"), ("table",))
        elif tag == "tr":
            self._close_implied(("td", "th", "tr"), ("table",), outermost=True)
        if tag == "br":
            self.line.parts.append(" ")
        if tag in VOID:
            if tag in BLOCKS:
                self._end_line()
            return
        top = self.open[-1]
        inside = top.inside or top.tag in ("article", "main")
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append(Open(tag, len(self.tags), top.noise or _is_noise(tag, attrs, inside), top.silent or tag in SILENT, inside))
        self.tags.append(tag)
        self.parents.append(top.number)
        self.last.append(0)
        if tag in BLOCKS or self.open[-1].noise != top.noise:
            self._end_line()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        places = self.places.get(tag)
        if places and (tag in BLOCKS or not self.blocks or places[-1] > self.blocks[-1]):
            self._pop_to(places[-1])
        elif tag in BLOCKS:
            self._end_line()

    def _close_implied(self, tags: tuple[str, ...], scope: tuple[str, ...], outermost: bool = False) -> None:
        """Close the innermost element of ``tags`` (or all of them) inside the innermost one of ``scope``."""
        floor = max((self.places[s][-1] for s in scope if self.places.get(s)), default=0)
        inner = [p for t in tags if (p := self.places.get(t)) and p[-1] > floor]
        if inner:
            self._pop_to(min(p[bisect_right(p, floor)] for p in inner) if outermost else max(p[-1] for p in inner))

    def _pop_to(self, k: int) -> None:
        gone = self.open[k:]
        del self.open[k:]
        for e in reversed(gone):
            self.places[e.tag].pop()
            self.last[e.number] = len(self.tags) - 1
            if e.tag in BLOCKS:
                self.blocks.pop()
        if any(e.tag in BLOCKS for e in gone) or any(e.noise for e in gone) != self.open[-1].noise:
            self._end_line()

    def handle_data(self, data: str) -> None:
        if not self.open[-1].silent:
            self.line.parts.append(data)
            if self.places.get("a"):
                self.line.linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_line()
        for e in self.open:
            self.last[e.number] = len(self.tags) - 1


def smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    """Convolution with a Gaussian of radius 3 sigma, its ends weighed anew."""
    radius = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - radius), min(len(values), i + radius + 1)
        weights = kernel[lo - i + radius : hi - i + radius]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi], strict=True)) / sum(weights))
    return out


def seeds_of(lines: list[Line], sigma: float = 1.0) -> list[int]:
    """The lines that are not noise and whose smoothed ratio reaches the deviation of all smoothed ratios; never none of some."""
    ratios = smoothed([len(x.text) / max(1, x.tags) for x in lines], sigma)
    clean = [i for i, x in enumerate(lines) if not x.noise]
    if not clean:
        return []
    mean = sum(ratios) / len(ratios)
    threshold = min(math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)), max(ratios[i] for i in clean))
    return [i for i in clean if ratios[i] >= threshold]


REGION_SHARE = 0.9
LINKED_SHARE = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements too small to be a region.
PARTS = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 td th tr b i a span em strong".split())


def region_of(reader: PageReader, seeds: list[int]) -> tuple[int, list[int]]:
    """The innermost element that holds nearly all text of the seeds, and the length of the seeds' text in each element."""
    weight = [0] * len(reader.tags)
    for i in seeds:
        weight[reader.lines[i].element] += len(reader.lines[i].text)
    total = sum(weight)
    for e in range(len(weight) - 1, 0, -1):
        weight[reader.parents[e]] += weight[e]
    return max(e for e, w in enumerate(weight) if e == 0 or w >= REGION_SHARE * total and reader.tags[e] not in PARTS), weight


def content_lines(reader: PageReader, seeds: list[int]) -> list[Line]:
    """The lines of the content around the seeds."""
    if not seeds:
        return []
    region, weight = region_of(reader, seeds)
    around: dict[str, int] = {}  # the outermost element of each tag that holds the region
    e = region
    while e:
        around[reader.tags[e]] = e
        e = reader.parents[e]
    within = lambda tag: [e for e in range(region, reader.last[region] + 1) if reader.tags[e] == tag]
    if "article" in around:
        articles = [around["article"]]
    else:
        articles = [e for e in within("article") if weight[e]] or ([around["main"]] if "main" in around else within("main") or within("article"))
    if articles:
        ends, kept = 0, []
        for e in articles:  # in page order: one that begins before the last one's end is inside it
            if reader.last[e] > ends:
                ends = reader.last[e]
                kept.append((e, ends))
        return [x for x in reader.lines if not x.noise and (k := bisect_right(kept, (x.element, len(reader.tags)))) and x.element <= kept[k - 1][1]]
    inside = [i for i, x in enumerate(reader.lines) if not x.noise and region <= x.element <= reader.last[region]]
    # A heading right before the region is that of the content.
    if inside[0] and not reader.lines[inside[0] - 1].noise and reader.tags[reader.lines[inside[0] - 1].element] in HEADINGS:
        inside.insert(0, inside[0] - 1)
    own = set(seeds)
    first = next(k for k, i in enumerate(inside) if i in own)
    last = next(k for k in range(len(inside) - 1, -1, -1) if inside[k] in own)
    text = lambda k: reader.lines[inside[k]].linked < LINKED_SHARE * len(reader.lines[inside[k]].text)
    while first > 0 and text(first - 1):
        first -= 1
    while last < len(inside) - 1 and text(last + 1):
        last += 1
    return [reader.lines[i] for i in inside[first : last + 1]]


def main_text(html: str | None) -> str:
    """The page's main text, its blocks joined by newlines."""
    if not html:
        return ""
    reader = PageReader()
    reader.feed(html)
    reader.close()
    return "\n".join(x.text for x in content_lines(reader, seeds_of(reader.lines)))


@F.arrow_udf(T.StringType())
def main_text_column(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(page.as_py()) for page in pages], pa.string())


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, url, text (empty if there is none), n_chars."""
    read = small_batches(pages).select(F.col(key).alias("_key"), F.col(url).alias("_url"), main_text_column(F.col(html).cast("string")).alias("_text"))
    return read.select(F.col("_key").alias(key), F.col("_url").alias("url"), F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))
