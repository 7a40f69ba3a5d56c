"""Main text of HTML pages by text-to-tag ratio.

The standard library's parser reads a page as a stream of events. Block elements cut it into lines; a
line's ratio is its characters outside links over its tags. Lines of elements that never hold the
article (menus, forms, scripts and so on by element or role, adverts and notices by the names in class
and id) have ratio zero. The ratios are smoothed along the page by a Gaussian, and lines above one
standard deviation of the smoothed ratios, or all with text on pages where nothing stands out, form the
content clusters.

Clusters choose the regions. Where most of their text lies in ``article`` or ``main`` elements, the regions
are these elements, and outside them the lines from the first to the last content line of each stretch;
otherwise the region is the innermost element that holds all content lines. In a region, lines of mostly
links are left out if they lie before the first or after the last content line, or in a run of
``LINK_RUN`` or more that are no content lines. Other lines stay: short paragraphs, lists, headings.

A name in class or id counts as a hint if all its parts are words for such elements or for boxes in
general, at least one of the former: ``cookie-bar`` does, ``legal-analysis`` does not. In an article, some
names (``DOUBTFUL``) count only where the element's text is mostly links or tags.

Defined results: null and empty html, and pages without text, give an empty text. Unclosed and
misnested elements end with their parent. Character references are decoded, white space (as ``str.split``
has it) in a block becomes one space, ``br`` is white space, blocks are joined by two line feeds. Rows
with equal ids or urls each give a row. Columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Width of the Gaussian in lines, and the share of the clusters' text that makes ``article`` or ``main``
#: elements the region.
SIGMA = 1.5
MOST = 0.6
#: Pages in one batch that a task hands back.
BATCH = 128

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that don't cut a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img br".split()
)
#: Elements whose text is never shown as text.
SILENT = frozenset(
    "script style head title noscript template iframe object svg math canvas audio video select "
    "option textarea button".split()
)
#: Elements that never hold the article.
APART = frozenset("nav footer aside form header dialog menu fieldset".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar".split()
)
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adsense sponsor sponsored promo promotion "
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars rail widget widgets "
    "footer foot header masthead topbar cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations comment comments commentlist disqus reply replies respond toolbar "
    "pagination pager login search hidden copyright legal disclaimer".split()
)
#: The words that also tell an ``article`` element apart: those of reader comments and adverts.
NOT_ARTICLES = frozenset(
    "comment comments reply replies related recommended ad ads advert sponsored promo teaser".split()
)
#: Words of class and id that say nothing about what an element holds.
PLAIN = frozenset(
    "box block container wrapper wrap list section area bar side top bottom left right inner outer main "
    "content item items row col column group panel holder slot unit zone region body head link links "
    "button buttons icon icons text title post posts article articles page site web global primary "
    "secondary fixed sticky small large full form field tool tools more all js is has iframe google "
    "bottombar wide label frame module component layout element mobile desktop".split()
)
#: Hints that, in an article, may also name a part of it.
DOUBTFUL = frozenset("share sharing social related legal search recommended".split())
#: Characters per tag under which the text of an element is mostly tags.
FEW_CHARS = 20
#: Lines of mostly links in a row that are a menu.
LINK_RUN = 3
#: Elements that hold one paragraph or less, and so are no region.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th pre figcaption caption address".split())
NO_REGION = INLINE | LEAVES
HEADER_HINTS = frozenset("header masthead banner".split())
WHOLE_PAGE = frozenset("html body".split())
#: An element of these ends when a sibling of the same kind begins, up to the given parents.
SIBLINGS = {
    "p": (frozenset(["p"]), frozenset("div article section td th li body main blockquote".split())),
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset("table thead tbody tfoot".split())),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
}
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Element:
    tag: str
    #: Its place among all elements in page order, and that of the last one inside it.
    number: int
    last: int
    #: The element around it that may be a region.
    holder: "Element | None"
    silent: bool
    apart: bool
    link: bool
    in_article: bool
    #: The innermost element around it, or itself, with a doubtful hint.
    doubt: "Doubt | None"


@dataclass
class Doubt:
    above: "Doubt | None"
    chars: int = 0
    link_chars: int = 0
    tags: int = 0
    apart: bool | None = None

    def add(self, chars: int, link_chars: int, tags: int) -> None:
        self.chars += chars
        self.link_chars += link_chars
        self.tags += tags

    def is_apart(self) -> bool:
        """Whether the text of the element, or of a doubtful one around it, is mostly links or tags."""
        chain = [self]
        while chain[-1].apart is None and chain[-1].above is not None:
            chain.append(chain[-1].above)
        apart = False
        for doubt in reversed(chain):
            if doubt.apart is None:
                heavy = 2 * doubt.link_chars > doubt.chars or doubt.chars < FEW_CHARS * doubt.tags
                doubt.apart = apart or heavy
            apart = doubt.apart
        return apart


@dataclass
class Line:
    text: str
    tags: int
    link_chars: int
    apart: bool
    #: The innermost open element that may be a region.
    holder: Element | None
    in_article: bool
    doubt: Doubt | None

    @property
    def of_links(self) -> bool:
        return 2 * self.link_chars > len(self.text)


def _hints(attrs: dict[str, str | None]) -> set[str]:
    """The hints in names of which all parts are hints or plain words."""
    found = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        words = {word.lower() for word in _PARTS.findall(name)}
        hints = words & HINTS
        if hints and all(w in PLAIN or w.isdigit() or len(w) == 1 for w in words - hints):
            found |= hints
    return found


def _hinted(tag: str, attrs: dict[str, str | None], in_article: bool) -> bool | None:
    """Whether an element is apart by its attributes; None if that depends on its text."""
    if tag in WHOLE_PAGE:
        return False
    if (attrs.get("role") or "").lower() in ROLES:
        return True
    style = (attrs.get("style") or "").replace(" ", "").lower()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style:
        return True
    hints = _hints(attrs)
    if tag in ("article", "main"):
        return not hints.isdisjoint(NOT_ARTICLES)
    if in_article:
        hints -= HEADER_HINTS  # in an article, a header holds the title
        if hints and hints <= DOUBTFUL:
            return None
    return bool(hints)


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        #: Places in ``open`` of each tag, and of the elements that cut lines.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.lines: list[Line] = []
        self.doubts: list[Doubt] = []
        self.count = 0
        self.parts: list[str] = []
        self.tags = self.link_chars = 0

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1] if self.open else None
            line = Line(
                text,
                self.tags,
                self.link_chars,
                top is not None and top.apart,
                top and (top if top.tag not in NO_REGION else top.holder),
                top is not None and top.in_article,
                top and top.doubt,
            )
            self.lines.append(line)
        self.parts, self.tags, self.link_chars = [], 0, 0

    def close_from(self, place: int) -> None:
        for element in reversed(self.open[place:]):
            element.last = self.count
            self.places[element.tag].pop()
            if element.tag not in INLINE:
                self.blocks.pop()
        del self.open[place:]

    def last_place(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "wbr"):
            self.parts.append(" " if tag == "br" else "")
            return
        if tag not in INLINE:
            self.cut()
            if tag in SIBLINGS:
                kinds, parents = SIBLINGS[tag]
                before = self.last_place(kinds)
                if before > self.last_place(parents | APART):
                    self.close_from(before)
        self.tags += 1
        if tag in VOID:
            return
        self.count += 1
        above = self.open[-1] if self.open else None
        in_article = above is not None and above.in_article
        hinted = _hinted(tag, dict(attrs), in_article) if attrs else False
        doubt = above and above.doubt
        if hinted is None:
            doubt = Doubt(doubt)
            self.doubts.append(doubt)
        article = tag in ("article", "main") and not hinted
        apart = hinted is True or (tag in APART and not (tag == "header" and in_article))
        if above is not None and above.apart and not article:
            apart = True
        silent = tag in SILENT or (above is not None and above.silent and tag != "body")
        # a hinted inline element is left out of its line
        silent = silent or (hinted is True and tag in INLINE)
        link = tag == "a" or (above is not None and above.link)
        holder = above and (above if above.tag not in NO_REGION else above.holder)
        within = in_article or (article and not (above is not None and above.silent))
        self.places.setdefault(tag, []).append(len(self.open))
        if tag not in INLINE:
            self.blocks.append(len(self.open))
        self.open.append(
            Element(tag, self.count, self.count, holder, silent, apart, link, within, doubt)
        )

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.cut()
        self.tags += 1
        place = self.last_place([tag])
        # an inline element doesn't end the blocks in it
        if place >= 0 and not (tag in INLINE and self.blocks and self.blocks[-1] > place):
            self.close_from(place)

    def handle_data(self, data):
        if self.open and self.open[-1].silent:
            return
        self.parts.append(data)
        if self.open and self.open[-1].link:
            self.link_chars += len(data)

    def unknown_decl(self, data):
        """A marked section is no text."""

    def finish(self) -> list[Line]:
        self.close()
        self.cut()
        self.close_from(0)
        for line in self.lines:
            if line.doubt is not None:
                line.doubt.add(len(line.text), line.link_chars, line.tags)
        for doubt in reversed(self.doubts):  # inner ones come after outer ones
            if doubt.above is not None:
                doubt.above.add(doubt.chars, doubt.link_chars, doubt.tags)
        for line in self.lines:
            line.apart = line.apart or (line.doubt is not None and line.doubt.is_apart())
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    if not len(ratios):
        return ratios
    reach = int(3 * sigma)
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    weights = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weights


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines the threshold puts into the content clusters."""
    ratios = np.array(
        [0 if n.apart else max(0, len(n.text) - n.link_chars) / max(n.tags, 1) for n in lines], float
    )
    if not ratios.any():
        ratios = np.array([0.0 if n.apart else float(len(n.text)) for n in lines])
    smooth = smoothed(ratios)
    return (smooth > smooth.std()) & (ratios > 0) if smooth.std() > 0 else ratios > 0


def _around(first: Element | None, last: Element | None) -> Element | None:
    """The innermost element that holds both lines' holders."""
    while first is not None and last is not None and not first.number <= last.number <= first.last:
        first = first.holder
    return first if last is not None else None


def _regions(lines: list[Line], chosen: np.ndarray) -> list[int]:
    """The places of the lines in the regions that the content lines choose."""
    wanted = [k for k in range(len(lines)) if chosen[k]]
    total = sum(len(lines[k].text) for k in wanted)
    in_articles = sum(len(lines[k].text) for k in wanted if lines[k].in_article)
    open_lines = [k for k, n in enumerate(lines) if not n.apart]
    if not wanted:
        return open_lines
    if in_articles < MOST * total:
        # lines come in page order, so what holds the first and the last holds all
        region = _around(lines[wanted[0]].holder, lines[wanted[-1]].holder)
        if region is None:
            return open_lines
        return [
            k
            for k in open_lines
            if lines[k].holder is not None and region.number <= lines[k].holder.number <= region.last
        ]
    kept, stretch = [], []
    for k in [*open_lines, len(lines)]:
        outside = k < len(lines) and not lines[k].in_article
        if outside:
            stretch.append(k)
            continue
        content = [j for j in stretch if chosen[j]]
        kept += [j for j in stretch if content and content[0] <= j <= content[-1]]
        stretch = []
        kept += [k] if k < len(lines) else []
    return kept


def _kept(lines: list[Line], chosen: np.ndarray) -> list[Line]:
    places = _regions(lines, chosen)
    content = [i for i, k in enumerate(places) if chosen[k]] or [0, len(places) - 1]
    result, menu = [], []
    for i, k in enumerate([*places, None]):
        if k is not None and lines[k].of_links and not chosen[k]:
            menu.append((i, lines[k]))
            continue
        if len(menu) < LINK_RUN:
            result += [line for at, line in menu if content[0] < at < content[-1]]
        menu = []
        result += [lines[k]] if k is not None else []
    # a page of links alone is its links
    return result or [lines[k] for k in places]


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    lines = parser.finish()
    if lines and all(n.apart for n in lines):
        # everything bears a hint: then the hints say nothing
        for n in lines:
            n.apart = False
    if not lines:
        return ""
    chosen = content_lines(lines)
    # a line of mostly links is content on a page of links only
    texts = chosen & ~np.array([n.of_links for n in lines])
    return "\n\n".join(n.text for n in _kept(lines, texts if texts.any() else chosen))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            texts = [main_text(html) for html in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    return (
        pages.select("page_id", "url", "html")
        .mapInArrow(_extracted, "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
