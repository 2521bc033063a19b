"""Operator 3: main text of web pages from parser events, text-to-tag ratios, smoothing and a threshold."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repledger.llm.common import in_arrow

# Fixed values of HTML: elements that end a line of text, that have no content, and whose content is never prose.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset(
    "aside button datalist dialog footer form head iframe menu nav noscript object option script select style svg "
    "template textarea title".split())
#: Words of class and id attributes that name what isn't the article.
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer header masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices popup promo promoted related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split())
#: A class of several words is no name if it begins or ends with one of these (`has-sidebar`, `comments-open`), or if
#: the name stands before two more words (`share-your-story`).
NOT_NAMES = (frozenset("has have is no not with without".split()),
             frozenset("closed collapsed disabled enabled hidden off on open visible".split()))
#: Names that also put a class outside by standing first in it.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising consent cookie cookies promo sponsor sponsored".split())
OUTSIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Containers whose lines stand or fall together.
REGIONS = frozenset("article main section div td body".split())
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")
#: Standard deviation of the smoothing, in lines, and the threshold in standard deviations of the smoothed ratios.
SIGMA, THRESHOLD = 1.0, 1.0


class Lines(HTMLParser):
    """Lines of a page as they stream by: text, tags seen in them, the region they lie in, and if that is outside."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, outside by itself, region
        self.outside, self.regions, self.kinds = 0, 0, ["page"]
        self.text: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                region = self.open[-1][2] if self.open else 0
                self.lines.append((text, self.tags, region, self.outside > 0))
                self.tags = 0
            self.text = []

    @staticmethod
    def names_outside(words: list[str], whole: bool) -> bool:
        """Whether a class or id, as words, names what isn't the article; `whole`: only if it is that name."""
        if len(words) < 2 or whole:
            return len(words) == 1 and words[0] in OUTSIDE_NAMES
        if words[0] in NOT_NAMES[0] or words[-1] in NOT_NAMES[1]:
            return False
        return words[0] in ADVERTS or any(w in OUTSIDE_NAMES for w in words[-2:])

    def is_outside(self, tag: str, attrs: list) -> bool:
        if tag in OUTSIDE:
            return True
        if tag == "header":
            return not any(x[0] in ("article", "main") for x in self.open)
        if tag in ("html", "body"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if value and name in ("class", "id"):
                whole = tag in ("article", "main")  # what is the content is put outside by a plain name only
                if any(self.names_outside(_NAME.findall(_CAMEL.sub(r"\1 \2", x).lower()), whole) for x in value.split()):
                    return True
            elif value and name == "role" and value.lower() in OUTSIDE_ROLES:
                return True
        return False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in ("article", "main") and self.outside and any(x[0] in ("nav", "header", "head") for x in self.open):
            while self.outside:  # an unclosed element before the article
                self.outside -= self.open.pop()[1]
        if tag == "body" and any(x[0] == "head" for x in self.open):
            while self.open and self.open[-1][0] != "html":
                self.outside -= self.open.pop()[1]
        if tag in ("p", "li") and self.open and self.open[-1][0] == tag and not self.open[-1][1]:
            self.open.pop()  # the end tag may be left out
        outside = bool(attrs or tag in OUTSIDE or tag == "header") and self.is_outside(tag, attrs)
        region = self.open[-1][2] if self.open else 0
        if tag in REGIONS and not (region and self.kinds[region] in ("article", "main") and tag not in ("article", "main")):
            self.regions += 1
            region = self.regions
            self.kinds.append(tag)
        self.open.append((tag, outside, region))
        self.outside += outside

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for _, outside, _ in self.open[k:]:
                    self.outside -= outside
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        if not self.open or self.open[-1][0] not in ("script", "style"):
            self.text.append(data)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; the weights near its ends are those that lie on it."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel)[reach:-reach] / np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]


def blocks(html: str) -> list[str]:
    """The blocks of the main text, in page order.

    Each line gets the length of its text by the tags in it, smoothed over its neighbours. Lines above the threshold
    are the content cluster. A region, the nearest article, main or other container of a line, is content if the
    cluster reaches into it; its other lines then come along, however short they are. Where a page has articles or
    a main part, only these count, and if the cluster reaches none of them, the one with most text does. Lines of
    menus, adverts, forms, comments and the like take part in the smoothing and are never content.
    """
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    inside = [k for k, x in enumerate(lines) if not x[3]]
    if not inside:
        return []
    kinds = parser.kinds
    named = [k for k in inside if kinds[lines[k][2]] in ("article", "main")]
    candidates = named or inside
    regions = {lines[k][2] for k in candidates}
    if len(regions) > 1:
        ratios = smooth(np.array([len(x[0]) / max(1, x[1]) for x in lines]))
        cluster = ratios >= min(THRESHOLD * ratios.std(), ratios.max())
        reached = {lines[k][2] for k in candidates if cluster[k]}
        if not reached:
            sizes: dict[int, int] = {}
            for k in candidates:
                sizes[lines[k][2]] = sizes.get(lines[k][2], 0) + len(lines[k][0])
            reached = {max(sizes, key=lambda r: (sizes[r], -r))}
        regions = reached
    return [lines[k][0] for k in candidates if lines[k][2] in regions]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, blocks, text) of every page, from its whole html; text is the blocks joined by a space.

    Null, empty and textless html gives no block and an empty text. Rows are taken each by itself, so repeated and null
    ids stay; an empty table gives no row. Other columns are left out.
    """
    def rows(batches):
        for batch in batches:
            found = [blocks(x.as_py() or "") for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.list_(pa.string())),
                 pa.array([" ".join(x) for x in found], pa.string())], ["page_id", "url", "blocks", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return in_arrow(pages.select("page_id", "url", "html"), rows,
                    f"page_id {kind}, url string, blocks array<string>, text string")
