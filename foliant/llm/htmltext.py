"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks (runs of text between block-level tags). A linear classifier over features of a block
(length, link share, end mark, heading, list of links, names in class and role) gives the cost of calling it content or
boilerplate; these are the capacities to source and sink. Blocks that follow each other, and blocks of one parent,
are joined by smoothness edges that are stronger the closer they are in the DOM; the container that a page has for its text joins each block in
it with the source, and each other block with the sink, by a capacity of its own. The maximum flow separates content from boilerplate.

A container's capacity is finite: ``ARTICLE`` for a page with an article, ``MAIN`` for one with a main element or an element named as content. It holds what looks
like no text (short blocks, lists, tables, links), unless all of a block's features speak against it. On other pages blocks are content
unless they look like boilerplate, by links and names.

The weights are fitted on pages that label their own blocks, those with a single ``article``: at most ``FIT_PAGES`` of them, of at
most ``FIT_CHARS`` characters. The fit is a logistic regression that is drawn towards ``PRIOR``, so that features which the
sample doesn't show keep a sensible weight.

What is no text by definition isn't left to the weights: elements of scripts, styles and form controls are left out, and
what lies in nav, header, footer, aside or form, in an element whose class is, as a whole, one of ``OUT_CLASSES``, or, outside of an article, whose id is one of
``OUT_IDS``, has a cost that no edge outweighs. All other names (parts of classes, ids of a div or a list) only count as features, and hidden text is text.

Parsing and cutting take time in proportion to the page.

Cases: null html is empty; a page without content blocks has the empty text; tags that are not closed end with their parent, with
``p`` and ``li`` as in HTML; broken references stay as they are. Without pages to fit on the weights are ``PRIOR``. Repeated rows repeat
their result; no rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

#: Fixed values of HTML: elements that hold no text of the page, void elements, and inline elements.
HIDDEN = frozenset("script style noscript template iframe canvas select textarea button head".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rb rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
FOREIGN = frozenset(("math", "svg"))
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dd dt".split())
LISTS = frozenset("ul ol dl table".split())
#: Elements that a start tag of the same group closes when they are open in the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
BOUNDS = frozenset("article section main div table ul ol dl body html nav aside header footer form blockquote td th".split())


#: Containers that hold no article text.
OUTSIDE = frozenset("nav header footer aside menu dialog".split())
#: Classes, roles and ids that name, as a whole, what the contract leaves out.
OUT_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising ad-banner ad-container ad-slot ad-unit comments comment-list commentlist comment-section comments-area reader-comments "
    "user-comments sidebar side-bar notice notices cookie-notice cookie-banner cookie-consent".split()
)
OUT_ROLES = frozenset("navigation complementary contentinfo banner search".split())
OUT_IDS = frozenset("ad ads comments commentlist disqus_thread respond sidebar".split())
#: Words in class, role or id that boilerplate often has, and others that it shares with text.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|side-?bars?|breadcrumbs?|footer|foot|comments?|replies|respond|cookies?|consent|gdpr|notices?|"
    r"notifications?|popup|newsletter|subscribe|subscription|signup|pagination|pager|nav|navbar|navigation|menus?|header|masthead|topbar|banner|login|toolbar|skip-?link)\d*(?=$|[\s_-])",
    re.I,
)
NAMES_SOFT = re.compile(
    r"(?:^|[\s_-])(?:copyright|legal|discussion|alerts?|modal|overlay|search|tags?|share|sharing|social|related|recommended|recommendations|widgets?)\d*(?=$|[\s_-])", re.I
)
STATES = re.compile(r"(?:^|(?<=[\s_-]))(?:with|has|no|without|show|hide|is)-[\w-]+", re.I)
#: Elements whose id counts as a name; ids of headings and sections are made from their titles.
WITH_ID = frozenset("div ul ol table".split())
#: Names of elements that hold the article where no article or main element does.
NAMES_IN = frozenset(
    "article main content post entry story main-content maincontent article-body article-content article-text post-body post-content entry-content story-body story-content page-content articlebody".split()
)
FREE, HARD, HEADER, WEAK = 0, 1, 2, 3

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
UNENDED = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
ATTR = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: HTML's white space; no-break spaces are text.
WHITE = re.compile("[ \t\n\r\f]+")

#: Bounds of the sample that the weights are fitted on.
FIT_PAGES, FIT_CHARS = 300, 50_000
#: Weights of ``features`` before any page is seen, and how many blocks they count for.
PRIOR, PRIOR_BLOCKS = np.array([-0.6, 1.2, -4.0, 0.8, 1.0, -2.0, -1.5, -2.5]), 50
#: Capacities of a page's container of text; what a block has for it on pages without one; and of a container of boilerplate.
ARTICLE, MAIN, PLAIN, BOILERPLATE = 9.0, 3.0, 0.5, 100.0


@dataclass
class Block:
    text: str
    parent: int  # number of the nearest block-level element
    depth: int  # of block-level elements
    common: int  # of these, how many hold the block before too
    outside: bool  # in a container of boilerplate
    inside: int  # 2 in an article, 1 in main or an element named as content
    head: bool
    in_list: bool
    soft: bool  # in an element with a name of NAMES_SOFT
    named: bool  # in an element with a name of NAMED, and in no article or content inside of that
    linked: int  # characters inside links


class Element:
    __slots__ = ("name", "number", "block", "hidden", "outside", "inside", "soft", "named", "alive")

    def __init__(self, name: str, number: int, block: bool, of: Element | None):
        self.name, self.number, self.block, self.alive = name, number, block, True
        self.hidden, self.outside, self.inside, self.soft, self.named = (of.hidden, of.outside, of.inside, of.soft, of.named) if of else (False, FREE, 0, False, False)


class Page:
    """Blocks of one page, from a single pass over its tags. Each tag costs no more than what it opens and closes."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        root = Element("#root", 0, True, None)
        self.open, self.made = [root], 0
        # places in ``open``, in order: of all elements by name, of block-level ones, of those that end the search for a p or an item
        self.at: dict[str, list[int]] = {"#root": [0]}
        self.tops, self.bounds, self.lists = [0], [0], [0]
        self.count = dict.fromkeys(("links", "heads", "items", "foreign"), 0)
        self.low = 1
        self.parts: list[str] = []
        self.linked = 0
        at, n = 0, len(html)
        last = html.rfind(">") + 1  # a "<" after it starts no tag
        while at < n:
            m = TOKEN.search(html, at, last) if at < last else None
            if not m:
                open_tag = UNENDED.search(html, max(at, last))  # a tag or comment that the page ends in is no text
                self.text(html[at : open_tag.start() if open_tag else n])
                break
            if m.start() > at:
                self.text(html[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if m[0].startswith("<![CDATA["):
                    self.text(m[0][9:-3])
                elif m[0].startswith("<!--") and not m[0].endswith("-->"):
                    break  # a comment that isn't closed
            elif m[1] or m[4]:
                self.end(name)
            else:
                attrs = (m[3] if m[2] else m[6]) or ""
                self.start(name, attrs)
                if name in RAW and not attrs.endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                    at = close.end() if close else n
                    self.end(name)
        self.flush()

    def text(self, raw: str) -> None:
        if not self.open[-1].hidden:
            self.parts.append(raw)
            if self.count["links"]:
                self.linked += len(raw.strip())

    def flush(self) -> None:
        if self.parts:
            text = WHITE.sub(" ", unescape("".join(self.parts))).strip(" \t\n\r\f")
            if text.strip():
                top, head = self.open[self.tops[-1]], self.count["heads"] > 0
                # of an article's own header, the headings are text
                outside = top.outside in (HARD, WEAK) or top.outside == HEADER and not head
                self.blocks.append(Block(text, top.number, len(self.tops), self.low, outside, top.inside, head, self.count["items"] > 0, top.soft, top.named, min(self.linked, len(text))))
                self.low = len(self.tops)
            self.parts, self.linked = [], 0

    def counted(self, name: str, by: int) -> None:
        if name == "a":
            self.count["links"] += by
        elif name in HEADS:
            self.count["heads"] += by
        elif name in ITEMS:
            self.count["items"] += by
        elif name in FOREIGN:
            self.count["foreign"] += by

    def push(self, e: Element) -> None:
        place = len(self.open)
        self.open.append(e)
        self.at.setdefault(e.name, []).append(place)
        if e.block:
            self.tops.append(place)
        if e.name in BOUNDS:
            self.bounds.append(place)
        if e.name in LISTS:
            self.lists.append(place)
        self.counted(e.name, 1)

    def cut(self, place: int) -> None:
        """Close what is open from ``place`` on, and what was closed before and is on top then."""
        while len(self.open) > place or not self.open[-1].alive:
            e = self.open.pop()
            if e.alive:
                self.at[e.name].pop()
                self.counted(e.name, -1)
            for places in (self.tops, self.bounds, self.lists):
                if places[-1] == len(self.open):
                    places.pop()
        self.low = min(self.low, len(self.tops))

    def start(self, name: str, attrs: str) -> None:
        inline = name in INLINE or self.count["foreign"] > 0
        if not inline:
            self.flush()
        if name in VOID or self.count["foreign"] and attrs.endswith("/"):
            return
        if not inline:
            if (name in ENDS_P or name == "body") and self.at.get("head"):
                self.cut(self.at["head"][-1])
            if name in ENDS_P:
                self.close_within("p", self.bounds)
            for other in CLOSES.get(name, ()):
                self.close_within(other, self.lists)
        self.made += 1
        e = Element(name, self.made, not inline, self.open[-1])
        e.hidden = e.hidden or name in HIDDEN
        if not inline:
            self.judge(e, attrs)
        self.push(e)

    def judge(self, e: Element, attrs: str) -> None:
        """What the element's name and attributes say of the text in it."""
        name = e.name
        if name in ("html", "body"):
            return
        said = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(attrs)} if "=" in attrs else {}
        classes, ids, roles = ((said.get(k) or "").split() for k in ("class", "id", "role"))
        content = bool(said) and not NAMES_IN.isdisjoint(" ".join(said.values()).lower().split())
        names = " ".join([*classes, *roles, *(ids if name in WITH_ID else ())])
        out = not OUT_CLASSES.isdisjoint(c.lower() for c in classes) or not OUT_ROLES.isdisjoint(roles) or e.inside < 2 and not OUT_IDS.isdisjoint(ids)
        if names:
            names = STATES.sub("", re.sub("([a-z])([A-Z])", r"\1-\2", names))
            e.soft, e.named = e.soft or bool(NAMES_SOFT.search(names)), e.named or bool(NAMED.search(names))
        if out:
            e.outside = HARD
        elif e.outside != HARD:
            if name in ("article", "main") or content and name not in OUTSIDE and name != "form":
                e.inside, e.outside, e.named = 2 if name == "article" else max(e.inside, 1), FREE, False
            elif name == "header" and e.inside:
                e.outside = e.outside or HEADER
            elif name in OUTSIDE or name == "form" and e.inside:
                e.outside = HARD
            elif name == "form":  # a form may hold the whole page
                e.outside = e.outside or WEAK

    def close_within(self, name: str, bounds: list[int]) -> None:
        places = self.at.get(name)
        if places and places[-1] >= bounds[-1] and places[-1] > 0:
            self.flush()
            self.cut(places[-1])

    def end(self, name: str) -> None:
        places = self.at.get(name)
        block = name not in INLINE and not self.count["foreign"]
        if block:
            self.flush()
        if not places or name == "#root":
            return
        place = places[-1]
        if not self.open[place].block and self.tops[-1] > place:
            # an inline element that blocks were opened in: only the element goes
            self.open[place].alive = False
            places.pop()
            self.counted(name, -1)
        else:
            if self.tops[-1] >= place:
                self.flush()
            self.cut(place)


def features(b: Block) -> tuple[float, ...]:
    link = b.linked / max(1, len(b.text))
    return (1.0, min(len(b.text), 200) / 100, link, float(b.text[-1] in ".!?…。！？\"”»"), float(b.head), float(b.in_list and link > 0.5), float(b.soft), float(b.named))


def own_labels(html: str | None) -> list[tuple[float, ...]]:
    """(label, *features) of each block of a page with a single article, else nothing."""
    if not html or len(re.findall("<article[\\s>]", html, re.I)) != 1:
        return []
    return [(float(b.inside == 2 and not b.outside), *features(b)) for b in Page(html).blocks]


def fit_weights(rows: np.ndarray) -> np.ndarray:
    """Logistic regression on (label, *features), both classes weighing the same, drawn towards ``PRIOR``; Newton's steps."""
    if not len(rows) or rows[:, 0].min() == rows[:, 0].max():
        return PRIOR
    y, x = rows[:, 0], rows[:, 1:]
    mass = np.where(y == 1, 1000 / y.sum(), 1000 / (1 - y).sum())
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (mass * (p - y)) + PRIOR_BLOCKS * (w - PRIOR)
        step = np.linalg.solve((x * (mass * p * (1 - p))[:, None]).T @ x + PRIOR_BLOCKS * np.eye(len(w)), slope)
        w = w - step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


#: Which features may speak for a block, and which against it, on a page without a container for its text.
FOR, AGAINST = np.array([0, 1, 0, 1, 1, 0, 0, 0], bool), np.array([0, 0, 1, 0, 0, 1, 1, 1], bool)
BY_NAME = np.array([0, 0, 0, 0, 0, 0, 1, 1], bool)


def leaning(b: Block, level: int, weights: np.ndarray) -> float:
    """What a block's own features say: above 0 for content. ``level`` is the page's largest ``inside``."""
    if not level:
        weights = np.where(FOR, np.maximum(weights, 0), np.where(AGAINST, np.minimum(weights, 0), 0))
    return float(np.dot(weights, features(b))) + (0.0 if level else PLAIN)


def costs(b: Block, level: int, weights: np.ndarray) -> tuple[float, float]:
    """Capacities to the source (the cost of calling the block boilerplate) and to the sink."""
    z = leaning(b, level, weights)
    source, sink = max(z, 0.0), max(-z, 0.0)
    if level:
        # an article outweighs all that can speak against a block but names
        held = max(ARTICLE, 0.5 - float(np.minimum(weights[~BY_NAME], 0).sum())) if level == 2 else MAIN
        source, sink = (source + held, sink) if b.inside >= level else (source, sink + held)
    return (source, sink + BOILERPLATE) if b.outside else (source, sink)


def smoothness(a: Block, b: Block) -> float:
    """Capacity between neighbours: larger for a deeper common container and a common parent; none across
    the edge of an article, of a container of boilerplate, or of an element with one of its names."""
    if a.outside != b.outside or a.named != b.named or (a.inside == 2) != (b.inside == 2):
        return 0.0
    return 1.5 if a.parent == b.parent else 1.2 * b.common / max(a.depth, b.depth)


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Side of each node: True with the source.

    A node whose own cost is at least the sum of its edges is on its own side in some minimum cut, so it is decided at once, and
    its edges become costs of its neighbours. Among the others the maximum flow is sent by blocking flows along shortest paths.
    """
    n = len(source)
    extra = [s - t for s, t in zip(source, sink, strict=True)]  # flow from source straight to sink is already sent
    to: list[list[list]] = [[] for _ in range(n)]
    weight = [0.0] * n
    for i, j, c in edges:
        if c > 0:
            x, y = [j, c, None], [i, c, None]
            x[2], y[2] = y, x
            to[i].append(x)
            to[j].append(y)
            weight[i] += c
            weight[j] += c
    side: list[bool | None] = [None] * n
    ready = [i for i in range(n) if abs(extra[i]) >= weight[i]]
    while ready:
        i = ready.pop()
        if side[i] is None:
            side[i] = extra[i] > 0
            for j, c, _ in to[i]:
                if side[j] is None:
                    weight[j] -= c
                    extra[j] += c if side[i] else -c
                    if abs(extra[j]) >= weight[j] - 1e-12:
                        ready.append(j)
    rest = [i for i in range(n) if side[i] is None]
    for i in rest:
        to[i] = [e for e in to[i] if side[e[0]] is None]
    while rest:
        level = {i: 0 for i in rest if extra[i] > 1e-9}
        queue, end = deque(level), None
        while queue:
            i = queue.popleft()
            if end is not None and level[i] >= end:
                break
            for j, c, _ in to[i]:
                if c > 1e-9 and j not in level:
                    level[j] = level[i] + 1
                    if extra[j] < -1e-9:
                        end = level[j]
                    queue.append(j)
        if end is None:
            for i in rest:
                side[i] = i in level
            break
        used = dict.fromkeys(level, 0)  # edges of a node that lead nowhere any more
        for start in [i for i, d in level.items() if d == 0]:
            path: list[list] = []
            at = start
            while extra[start] > 1e-9:
                if extra[at] < -1e-9 and path:
                    amount = min(extra[start], -extra[at], *(e[1] for e in path))
                    extra[start] -= amount
                    extra[at] += amount
                    for e in path:
                        e[1] -= amount
                        e[2][1] += amount
                    path, at = [], start
                    continue
                while used[at] < len(to[at]):
                    e = to[at][used[at]]
                    if e[1] > 1e-9 and level.get(e[0], -1) == level[at] + 1:
                        break
                    used[at] += 1
                else:
                    if not path:
                        break
                    at = path.pop()[2][0]
                    used[at] += 1
                    continue
                path.append(e)
                at = e[0]
    return [bool(x) for x in side]


def sides(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """Whether each block is content, by the minimum cut."""
    level = max((b.inside for b in blocks if not b.outside), default=0)
    source, sink = map(list, zip(*(costs(b, level, weights) for b in blocks), strict=True))
    edges = [(i, i + 1, smoothness(blocks[i], blocks[i + 1])) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):  # the last block of the same parent, where it isn't the neighbour
        j = last.get(b.parent)
        if j is not None and j < i - 1 and blocks[j].outside == b.outside:
            edges.append((j, i, 0.8))
        last[b.parent] = i
    return minimum_cut(source, sink, edges)


def main_text(html: str | None, weights: np.ndarray | None = None) -> str:
    blocks = Page(html).blocks if html else []
    if not blocks:
        return ""
    return "\n".join(b.text for b, content in zip(blocks, sides(blocks, PRIOR if weights is None else weights), strict=True) if content)


def fit(pages: DataFrame, most: int = FIT_PAGES, chars: int = FIT_CHARS) -> np.ndarray:
    """Weights from at most ``most`` pages, those of the smallest hash of their html. About four times as many are looked
    at, so that what meets in one task doesn't grow with the table; copies count once."""
    n = pages.count()
    share = min(1.0, 4 * most / max(n, 1))
    mark = F.xxhash64("html")
    drawn = pages.where((mark <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))) & (F.length("html") <= chars)).select(mark.alias("mark"), "html").dropDuplicates(["mark"]).orderBy("mark").limit(most)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = np.array([r for h in b.column("html").to_pylist() for r in own_labels(h)]).reshape(-1, 1 + len(PRIOR))
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array([rows.astype(np.float64).tobytes()], pa.binary())], ["rows"])

    got = drawn.select("html").mapInArrow(labelled, "rows binary").toArrow()["rows"].to_pylist()
    rows = np.frombuffer(b"".join(got), np.float64).reshape(-1, 1 + len(PRIOR))
    return fit_weights(rows[np.lexsort(rows.T)])  # the order of sums stays the same


def extract(pages: DataFrame, weights: np.ndarray) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = [main_text(h, weights) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return extract(pages, fit(pages))
