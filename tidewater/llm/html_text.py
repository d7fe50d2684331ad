"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold clustering.

The standard library's parser is fed a page in pieces; its events become
*lines*, one per block of text, each with its characters, tags, link characters
and the elements around it.  Lines inside elements that say they are not the
article (navigation, footer, aside, form, ... by tag, role or class word) are
left out.  Of the others, the ratio of unlinked characters to tags is smoothed
with a Gaussian along the page, never across an element that starts or ends a
region, and lines at or above the threshold (the standard deviation of the
smoothed ratios), or as long as a sentence outside their links, are content
lines.  The regions are the outermost article and main elements with content
(else the page), each narrowed only while one element inside holds its heading
and all its content lines; all their remaining lines are the text.  A page's
main heading before an article without one belongs to it, with the lines
between.  Of runs of links only those that lead nowhere are left out.

Defined results
  null or empty html, or a page without text outside the left-out elements:
  empty text, n_chars 0.  Repeated rows and ids: one result each.  Broken
  markup, unclosed elements and unknown references never fail; an element left
  open ends with its parent.  Other columns are ignored; empty table: no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 16
SIGMA = 1.0
#: Unlinked characters of a line that is content however much longer the others are.
SENTENCE = 50
#: Lines of links without a target in a row, at this link share, are a menu of controls.
MENU_LINES, MENU_SHARE = 3, 0.9

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea "
    "title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGION = frozenset("article aside body div footer form header main nav section td".split())
CLOSES = {  # an opening element ends an open one of the first, inside the innermost of the second
    "li": (("li",), frozenset(("ul", "ol", "menu"))),
    "dt": (("dt", "dd"), frozenset(("dl",))),
    "dd": (("dt", "dd"), frozenset(("dl",))),
    "tr": (("tr", "td", "th"), frozenset(("table",))),
    "td": (("td", "th"), frozenset(("tr", "table"))),
    "th": (("td", "th"), frozenset(("tr", "table"))),
    "option": (("option",), frozenset(("select",))),
}
#: A paragraph does not reach out of these.
HOLDS_P = BLOCK - {"p"}
# Class and id words of what is not the article.
NOISE = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs footer sidebar cookie cookies consent gdpr notice popup modal overlay alert comment comments "
    "commentlist respond disqus share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search toolbar pagination pager skip masthead copyright widget teaser outbrain taboola".split()
)
#: With one of those, these make a name of the same kind: ``ad-slot``, ``related-posts``, ``cookie-bar``.
FRAME = frozenset(
    "box block area container wrapper wrap list lists section sections inner outer bar item items link links panel left right top "
    "bottom main primary secondary header heading title head foot group slot unit row col column page site global button buttons "
    "icon icons form field input post posts article articles story stories news content body module card cards feed tools".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


class Element:
    """An open or closed element.

    ``out``: it or an element around it is left out by tag or role.  ``named``:
    the nearest such element by class or id, itself included.  ``home``: the
    nearest region, itself included.  ``heading``: the tag of the nearest heading,
    itself included.  ``hint``: the nearest element whose class only holds such a word.
    ``in_main``: inside an article or main element.  ``target``: the nearest link, itself included, leads somewhere.
    All are inherited when an element opens, so nothing walks up a deep page again
    for each line.
    """

    __slots__ = ("tag", "parent", "main", "out", "named", "home", "heading", "target", "holds_main", "holds_title", "hint", "in_main", "held", "depth", "inside")

    def __init__(self, tag, parent, noise, main, region, target=None):
        self.tag, self.parent, self.main = tag, parent, main
        self.out = noise == "tag" or (parent is not None and parent.out)
        self.named = self if noise == "name" else parent and parent.named
        self.hint = self if noise == "hint" else parent and parent.hint
        self.in_main = main or (parent is not None and parent.in_main)
        self.home = self if region or parent is None else parent.home
        self.depth = 0 if parent is None else parent.home.depth + (self.home is self)
        self.heading = tag if tag in HEADINGS else parent and parent.heading
        self.target = parent is not None and parent.target if target is None else target
        self.holds_main = self.holds_title = self.inside = False
        self.held = 0


class Line:
    __slots__ = ("text", "tags", "linked", "targets", "at", "ratio", "smooth")

    def __init__(self, text, tags, linked, targets, at):
        self.text, self.tags, self.linked, self.targets, self.at = text, tags, linked, targets, at
        self.ratio = self.smooth = 0.0

    def link_share(self) -> float:
        return min(1.0, self.linked / max(1, len(self.text)))


def _noise(tag: str, attrs: dict, inside_main: bool):
    if tag in DROPPED or (tag == "header" and not inside_main):
        return "tag"
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in ROLES:
        return "tag"
    if re.search(r"display\s*:\s*none", attrs.get("style") or ""):
        return "tag"
    if tag in ("html", "body", "main") or tag in VOID:
        return False
    kinds = {_kind(token) for token in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()}
    if "name" in kinds:
        return "name" if tag in BLOCK else "tag"  # inside a line there is no article to hold
    return "hint" if "hint" in kinds and tag in BLOCK and tag not in ("article", "p") else False


@lru_cache(maxsize=1 << 16)
def _kind(token: str):
    """``name``: a class of what is not the article, as a whole (``ads``, ``ad-slot``).  ``hint``: it
    holds such a word beside others (``ad-hoc``, ``related-work``, ``widget-text``)."""
    words = [w.lower().rstrip("0123456789") for w in _WORD.findall(token)]
    words = [w for w in words if len(w) > 1]
    if not any(w in NOISE for w in words):
        return None
    return "name" if all(w in NOISE or w in FRAME for w in words) else "hint"


def _leads(href: str) -> bool:
    """A link to another page or a named place; the others are controls of a script."""
    href = href.strip().lower()
    return href not in ("", "#") and not href.startswith("javascript:")


class Lines(HTMLParser):
    """Collects the lines and regions of a page from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = Element("#page", None, False, False, True)
        self.regions = [self.open]  # outer before inner
        self.counts: Counter[str] = Counter()  # open elements by tag
        self.mains = 0
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags, self.linked, self.targets = 0, 0, False

    def break_line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.linked, self.targets, self.open))
        self.parts, self.tags, self.linked, self.targets = [], 0, 0, False

    def end(self, node: Element):
        """Close ``node`` and all that is open inside it."""
        while True:
            closed, self.open = self.open, self.open.parent
            self.counts[closed.tag] -= 1
            self.mains -= closed.main
            if closed is node:
                return

    def find(self, wanted: tuple[str, ...], until: frozenset[str]):
        """The innermost open element of ``wanted`` that is not outside one of ``until``."""
        if not any(self.counts[t] for t in wanted):
            return None
        node = self.open
        while node.parent is not None and node.tag not in until:
            if node.tag in wanted:
                return node
            node = node.parent
        return None

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.break_line()
            if paragraph := self.find(("p",), HOLDS_P):
                self.end(paragraph)
            if tag not in ("head", "html") and (head := self.find(("head",), frozenset())):
                self.end(head)
            if tag in CLOSES and (other := self.find(*CLOSES[tag])):
                self.end(other)
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        main = tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"
        target = _leads(given.get("href", "")) if tag == "a" else None
        noise = _noise(tag, given, self.mains > 0)
        main = main and noise != "name"  # a comment or an advert may be an article element
        node = Element(tag, self.open, noise, main, main or tag in REGION, target)
        if main or tag == "h1":
            above = self.open
            while above is not None and not (above.holds_main and (above.holds_title or tag != "h1")):
                above.holds_main, above.holds_title = True, above.holds_title or tag == "h1"
                above = above.parent
        if node.home is node:
            self.regions.append(node)
        self.counts[tag] += 1
        self.mains += main
        self.open = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.break_line()
        self.tags += 1
        if node := self.find((tag,), frozenset() if tag in BLOCK else BLOCK):
            self.end(node)

    def handle_data(self, data):
        if self.open.out:
            return
        self.parts.append(data)
        if self.counts["a"]:
            self.linked += len(data.strip())
            self.targets |= self.open.target and not data.isspace()


def parsed(html: str) -> Lines:
    if html.rfind("<!--") > html.rfind("-->"):
        html += "-->"  # a comment left open ends with the page
    parser = Lines()
    for i in range(0, len(html), PIECE):
        parser.feed(html[i : i + PIECE])
    parser.close()
    parser.break_line()
    return parser


def believed(lines: list[Line]) -> set[Element]:
    """The elements whose name says that they are not the article, and are believed.

    A name alone is not believed of an element that holds the page's main heading, nor of one
    that holds an article, unless more article text lies outside it (teasers of
    other articles).
    """
    inside: Counter[Element] = Counter()
    total = 0
    for line in lines:
        size = len(line.text) if line.at.in_main else 0
        total += size
        node = line.at.named
        while node is not None:
            inside[node] += size
            node = node.parent.named
    return {node for node, size in inside.items() if not node.holds_main or (not node.holds_title and total - size > size)}


def without_noise(lines: list[Line]) -> list[Line]:
    """Lines outside elements that are left out by tag, role or a believed name, and outside
    those with a hint in their class that hold no sentence or are mostly links."""
    lines = [x for x in lines if not x.at.out]
    names = believed(lines)
    kept = []
    for line in lines:
        node = line.at.named
        while node is not None and node not in names:
            node = node.parent.named
        if node is None:
            kept.append(line)
    hinted: dict[Element, list[Line]] = {}
    for line in kept:
        node = line.at.hint
        while node is not None:
            hinted.setdefault(node, []).append(line)
            node = node.parent.hint
    gone = set()
    for node, some in hinted.items():
        linked, size = sum(x.linked for x in some), sum(len(x.text) for x in some)
        prose = any(len(x.text) - x.linked >= SENTENCE for x in some)
        if not node.holds_main and (not prose or 2 * linked >= size):
            gone.update(map(id, some))
    return [x for x in kept if id(x) not in gone]


def smooth(lines: list[Line], sigma: float = SIGMA) -> None:
    """Gaussian smoothing of the ratios along each run of lines of one region."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]
    start = 0
    while start < len(lines):
        home, stop = lines[start].at.home, start
        while stop < len(lines) and lines[stop].at.home is home:
            stop += 1
        for i in range(start, stop):
            near = range(max(start, i - reach), min(stop, i + reach + 1))
            total = sum(weights[abs(i - j)] for j in near)
            lines[i].smooth = sum(weights[abs(i - j)] * lines[j].ratio for j in near) / total
        start = stop


def content_lines(lines: list[Line]) -> list[Line]:
    """Lines at or above the standard deviation of the smoothed ratios, and sentences."""
    mean = sum(x.smooth for x in lines) / len(lines)
    deviation = math.sqrt(sum((x.smooth - mean) ** 2 for x in lines) / len(lines))
    found = [x for x in lines if len(x.text) - x.linked >= SENTENCE or (x.smooth > 0 and x.smooth >= deviation)]
    return found or lines


def heading_of(lines: list[Line], content: list[Line]) -> Line | None:
    """The main heading nearest before the content, else any, else the nearest heading of another level."""
    body = next((x for x in content if not x.at.heading), None)
    before = lines[: lines.index(body)] if body else lines
    for some, tags in ((before, ("h1",)), (lines[::-1], ("h1",)), (before, HEADINGS)):
        if found := [x for x in some if x.at.heading in tags]:
            return found[-1]
    return None


def narrowed(regions: list[Element], held: list[Line]) -> Element:
    """The innermost region around all of ``held``."""
    for region in regions:
        region.held = 0
    for line in held:
        line.at.home.held += 1
    for region in reversed(regions[1:]):
        region.parent.home.held += region.held
    return max((r for r in regions if r.held == len(held)), key=lambda r: r.depth)


def _mark_inside(regions: list[Element], chosen: list[Element]) -> None:
    marked = set(chosen)
    for r in regions:
        r.inside = r in marked or (r.parent is not None and r.parent.home.inside)


def article_lines(regions: list[Element], lines: list[Line]) -> list[Line]:
    """The lines of the outermost article and main elements, else of the page, each
    narrowed past what is beside its heading and content."""
    outer: dict[Element, Element] = {}  # of each region inside a marked one, the outermost marked
    own: dict[Element, list[Element]] = {regions[0]: regions}
    for r in regions:
        if top := (r.parent and outer.get(r.parent.home)) or (r if r.main else None):
            outer[r] = top
            own.setdefault(top, []).append(r)
    scopes: dict[Element, list[Line]] = {}
    for line in lines:
        if (top := outer.get(line.at.home)) is not None:
            scopes.setdefault(top, []).append(line)
    if not scopes:
        scopes = {regions[0]: lines}
    content = {id(x) for x in content_lines([x for some in scopes.values() for x in some])}
    chosen = []
    for top, some in scopes.items():
        # An article without any content line beside one with some is none.
        if held := [x for x in some if id(x) in content]:
            heading = heading_of(some, held)
            chosen.append(narrowed(own[top], held + [heading] if heading else held))
    _mark_inside(regions, chosen)
    kept = [x.at.home.inside for x in lines]
    first = kept.index(True)
    if not any(k and x.at.heading == "h1" for k, x in zip(kept, lines, strict=True)):
        above = max((i for i in range(first) if lines[i].at.heading == "h1"), default=first)
        kept[above:first] = [True] * (first - above)
    return [x for k, x in zip(kept, lines, strict=True) if k]


def without_menus(lines: list[Line]) -> list[Line]:
    """Drops runs of lines that are nearly all link and lead nowhere."""
    out: list[Line] = []
    run: list[Line] = []
    for line in [*lines, None]:
        if line is not None and not line.targets and line.link_share() >= MENU_SHARE:
            run.append(line)
            continue
        out += run if len(run) < MENU_LINES else []
        run = []
        if line is not None:
            out.append(line)
    return out


def main_text(html: str | None) -> str:
    """The article's blocks joined by newlines."""
    page = parsed(html or "")
    lines = without_noise(page.lines)
    if not lines:
        return ""
    for line in lines:
        line.ratio = (len(line.text) - min(line.linked, len(line.text))) / max(1, line.tags)
    smooth(lines)
    return "\n".join(x.text for x in without_menus(article_lines(page.regions, lines)))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; no shuffle, one page in memory at a time."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            pages = batch.column("html")
            texts = [main_text(pages[i].as_py()) for i in range(len(pages))]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
