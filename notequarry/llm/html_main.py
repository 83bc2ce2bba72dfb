"""Main text of web pages, by minimum-cut labelling of their blocks.

A page is cut into text blocks at its block-level tags. A logistic classifier gives each
block a probability of being main text from its length, links, punctuation and place; with
what the enclosing tags and their class names say, its log odds become capacities from a
source (main text) and to a sink (everything else). Blocks that follow each other, and
blocks near each other in the document tree, are tied by edges whose capacity falls with
their distance. The minimum cut is the labelling that pays least for going against the
classifier and for parting neighbours; it is found by augmenting paths.

The classifier learns from pages themselves: blocks inside article or main tags are taken as
main text and blocks in navigation, footers and asides as the rest, on a bounded sample.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notequarry.llm.common import columns, text_bytes

#: Pages the classifier learns from, about, and ridge of its weights.
SAMPLE_PAGES = 2_000
RIDGE = 1.0
#: Capacity of an edge between neighbours, and how it falls with their distance in the tree.
TIE, FALL = 1.0, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|select|svg|math|iframe|object|canvas|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
#: Tags whose name inside the main text says what they are about, unless a whole class is meant.
_TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table tr td th pre blockquote figure figcaption caption".split())
#: Steps in the tree beyond which blocks count as infinitely far from each other.
FARTHEST = 60
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same kind.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSERS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_MAIN = frozenset(("article", "main"))
_REST = frozenset("nav footer aside form button menu dialog head select fieldset".split())
#: Tags that also wrap whole pages; like names they say little of a container of the main text.
_WRAPPERS = frozenset(("form", "fieldset"))
_REST_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login register sidebar side rail widget widgets menu "
    "menus nav navbar navigation navigationbar breadcrumb breadcrumbs crumbs pagination pager footer footnav header masthead topbar toolbar "
    "comment comments commentlist discussion disqus replies reply respond responses share sharing social related recommended "
    "recommendations teaser trending popular tags copyright legal disclaimer search complementary contentinfo skip hidden toc".split()
)
_MAIN_WORDS = frozenset("article articlebody content entry post story maincontent main body text prose".split())


@dataclass
class Open:
    """An element: its tag, the one around it, and what its tag and names say."""

    tag: str
    parent: Open | None = None
    depth: int = 0
    rest: bool = False
    main: bool = False
    named_main: bool = False
    #: whether ``rest`` comes from names or a form alone
    weak: bool = False
    #: characters of tagged text below
    inside: int = 0
    #: of the element or those around it: main, named main, rest, strong rest, header, and
    #: whether a main tag stands below the last rest
    any_main: bool = False
    any_named: bool = False
    any_rest: bool = False
    any_strong: bool = False
    any_header: bool = False
    main_after: bool = False

    def inherit(self) -> None:
        """Sums up the elements around, which must have done so before."""
        up = self.parent
        self.any_main = self.main or up is not None and up.any_main
        self.any_named = self.named_main or up is not None and up.any_named
        self.any_rest = self.rest or up is not None and up.any_rest
        self.any_strong = self.rest and not self.weak or up is not None and up.any_strong
        self.any_header = self.tag == "header" or up is not None and up.any_header
        self.main_after = not self.rest and (self.tag == "main" or up is not None and up.main_after)


@dataclass
class Block:
    """A text block: its text, the element it stands in, and counts."""

    text: str
    element: Open
    linked: int
    main: bool = False
    rest: bool = False
    named_main: bool = False

    @property
    def tag(self) -> str:
        return self.element.tag


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; scripts, styles, comments of the markup and the title are no text."""
    root = Open("")
    stack: list[Open] = [root]
    every: list[Open] = [root]
    open_tags: Counter[str] = Counter()
    found: list[Block] = []
    held: list[str] = []
    linked = links = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            found.append(Block(text, stack[-1], linked))
        linked = 0

    def close() -> str:
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            held.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        if m[1] or m[3] is None:  # script and the like, comment, declaration
            continue
        tag = m[3].lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links + (-1 if m[2] else 1))
            continue
        if m[2]:
            if open_tags[tag]:
                flush()
                while close() != tag:
                    pass
                links = 0
            continue
        flush()
        if tag in _VOID:
            continue
        links = 0
        if tag in _CLOSERS and stack[-1].tag == "p":
            close()
        while stack[-1].tag in _ENDS.get(tag, ()):
            close()
        up = stack[-1]
        opened = Open(tag, up, up.depth + 1, tag in _REST, tag in _MAIN, weak=tag in _WRAPPERS)
        if m[4]:
            words, hidden = _said(tag, m[4], up.any_main)
            opened.named_main = bool(words & _MAIN_WORDS)
            # names of main, and of an article that is called a post too, say what stands beside it
            own = tag == "main" or tag == "article" and opened.named_main
            if tag not in ("html", "body") and not own and words & _REST_WORDS:
                opened.weak |= not opened.rest
                opened.rest = True
            if tag not in ("html", "body") and hidden:
                opened.rest, opened.weak = True, False
        opened.inherit()
        every.append(opened)
        stack.append(opened)
        open_tags[tag] += 1
    held.append(page[at:])
    flush()
    _settle(found, every)
    return found


def _said(tag: str, attributes: str, inside_main: bool) -> tuple[frozenset[str], bool]:
    """The words of an element's names, and whether its attributes hide it.

    An id of a heading is made from its words, and says nothing; nor does one of the text's
    own tags inside the main text, where only a whole class is a name.
    """
    words, hidden = set(), False
    for name, *value in _ATTRIBUTE.findall(attributes):
        name, text = name.lower(), "".join(value)
        if name in ("class", "id", "role", "itemprop"):
            if tag in _TEXTUAL and (inside_main or name == "id"):
                words.update(text.lower().split() if name != "id" else ())
            else:
                words.update(re.split(r"[^a-z0-9]+", _spread(text).lower()))
        hidden |= name == "hidden" and text.lower() != "false" or name == "aria-hidden" and text.lower() == "true"
        hidden |= name == "style" and bool(_HIDING.search(text))
    return frozenset(words), hidden


def _settle(blocks: list[Block], every: list[Open]) -> None:
    """Says which blocks are main text or the rest by the tags around them.

    A form or a name such as has-sidebar is no sign against a container of most of the main
    text, where hardly any of that would be left otherwise. ``every`` has the elements with
    those around them first, so what holds for a path is handed down once.
    """
    for b in blocks:
        b.named_main = b.element.any_named
    tagged = [b.named_main or b.element.any_main for b in blocks]
    if not any(tagged):
        tagged = [True] * len(blocks)
    size = left = 0
    for b, counts in zip(blocks, tagged, strict=True):
        if counts:
            size += len(b.text)
            left += 0 if b.element.any_rest else len(b.text)
            b.element.inside += len(b.text)
    for x in reversed(every):
        if x.parent is not None:
            x.parent.inside += x.inside
    if 50 * left < size:
        for x in every:
            if x.weak and x.inside and (2 * x.inside > size or x.main):
                x.rest = False
        for x in every:
            x.inherit()
    for b in blocks:
        x = b.element
        # main inside a container that only a name calls the rest is main; so is a header inside the article
        if x.any_rest and not (x.main_after and not x.any_strong):
            b.rest = True
        elif not x.any_main:
            b.rest = x.any_header
        b.main = x.any_main and not b.rest


def _spread(name: str) -> str:
    """navBar as nav-Bar."""
    return re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name)


def features(block: Block, index: int, count: int) -> list[float]:
    size = len(block.text)
    return [
        1.0,
        math.log1p(size) / 5,
        min(1.0, block.linked / max(1, size)),
        min(1.0, 20 * sum(block.text.count(c) for c in ".,;:!?") / max(1, size)),
        float(block.tag in ("li", "ul", "ol", "td", "th")),
        float(block.tag in ("p", "blockquote", "pre", "")),
        abs(2 * (index + 0.5) / max(1, count) - 1),
    ]


def learn(rows: np.ndarray, labels: np.ndarray, share: np.ndarray, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression over weighted rows, by Newton steps."""
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ ((p - labels) * share) + RIDGE * weights
        curve = (rows * (p * (1 - p) * share)[:, None]).T @ rows + RIDGE * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    return weights


#: Weights used where a sample holds no block of one of the two sorts.
PLAIN = np.array([-2.0, 2.5, -4.0, 1.0, -1.0, 1.0, -0.5])


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights learnt from about ``sample`` pages, chosen by a hash of the page.

    What a page adds is summed in the tasks: only rows of counted features travel.
    """
    total = pages.count()
    share = min(1.0, sample / max(1, total))
    hashed = F.pmod(F.xxhash64(F.lit("pages"), F.coalesce(html_col, F.lit(""))), F.lit(1_000_003)) / 1_000_003.0
    drawn = pages.filter(hashed < share).select(F.col(html_col).alias("html"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made, labels = [], []
            for page in text_bytes(batch.column(0)):
                blocks = blocks_of(page.decode("utf-8", "replace"))
                for i, x in enumerate(blocks):
                    if x.main or x.rest:
                        made.append([round(v, 2) for v in features(x, i, len(blocks))])
                        labels.append(int(x.main))
            yield pa.record_batch([pa.array(made, pa.list_(pa.float64())), pa.array(labels, pa.int64())], ["row", "label"])

    counted = drawn.mapInArrow(run, "row array<double>, label long").groupBy("row", "label").count().toArrow()
    labels, n = counted.column("label").to_numpy(), counted.column("count").to_numpy()
    if len(set(labels.tolist())) < 2:
        return PLAIN
    rows = np.array(counted.column("row").to_pylist())
    # both sorts weigh the same in all, their rows by how often they were met
    share = np.where(labels == 1, n / n[labels == 1].sum(), n / n[labels == 0].sum()) * 1000
    return learn(rows, labels, share)


def evidence(blocks: list[Block], weights: np.ndarray) -> list[float]:
    """Log odds of each block being main text: classifier, and what its tags and names say."""
    structured = any(x.main for x in blocks) or any(x.named_main and not x.rest for x in blocks)
    found = []
    for i, x in enumerate(blocks):
        odds = max(-4.0, min(4.0, sum(w * v for w, v in zip(weights, features(x, i, len(blocks)), strict=True))))
        if x.rest:
            odds -= 12.0
        elif x.main:
            odds += 10.0
        elif structured:
            odds += 6.0 if x.named_main else -6.0
        found.append(odds)
    return found


def distance(a: Open, b: Open) -> int:
    """Steps between two elements of the tree, up to FARTHEST."""
    steps = 0
    while a is not b and steps < FARTHEST:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut.

    ``odds`` above 0 is capacity from the source, below 0 capacity to the sink. Flows are
    blocked level by level: each round sends all it can along shortest paths.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        for x, y, capacity in ((a, b, there), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(capacity)

    for i, x in enumerate(odds):
        if x > 0:
            join(source, i, x, 0.0)
        elif x < 0:
            join(i, sink, -x, 0.0)
    for (a, b), capacity in edges.items():
        join(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                first = 0
                for k in range(len(path) - 1, -1, -1):
                    room[path[k]] -= flow
                    room[path[k] ^ 1] += flow
                    if room[path[k]] <= 1e-9:
                        first = k
                at = to[path[first] ^ 1]
                del path[first:]
                continue
            while following[at] < len(out[at]):
                e = out[at][following[at]]
                if room[e] > 1e-9 and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                following[at] += 1
            else:
                if at == source:
                    break
                e = path.pop()
                at = to[e ^ 1]
                following[at] += 1


def label(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """True for blocks of the main text: every block is a node, tied to the one before it
    and to the one before it under the same element."""
    edges: dict[tuple[int, int], float] = {}
    by_parent: dict[int, int] = {}
    for n, x in enumerate(blocks):
        parent = id(x.element.parent)
        for m in {n - 1, by_parent.get(parent, -1)}:
            if m >= 0:
                far = max(0, distance(blocks[m].element, x.element) - 2)
                edges[m, n] = TIE * FALL**far
        by_parent[parent] = n
    return min_cut(evidence(blocks, weights), edges)


def main_text(page: str, weights: np.ndarray = PLAIN) -> str:
    """Main text of one page: its blocks in page order, joined by one space."""
    blocks = blocks_of(page)
    return " ".join(b.text for b, keep in zip(blocks, label(blocks, weights), strict=True) if keep)


def extract(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row.

    - A null or empty page, and one without main text, has an empty text.
    - Tags that are never closed, or cut off, end where the page ends.
    - Repeated rows give repeated rows; other columns are ignored.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [main_text(x.decode("utf-8", "replace"), weights) for x in text_bytes(batch.column(2))]
            made = [pa.array(found, pa.string()), pa.array([*map(len, found)], pa.int64())]
            yield pa.record_batch([batch.column(0), batch.column(1), *made], ["page_id", "url", "text", "n_chars"])

    narrow = columns(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = [narrow.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return narrow.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
