"""Main-text extraction from HTML by minimum-cut labelling of blocks.

A page becomes a row of blocks of text. A logistic classifier gives each block
the cost of being called content or boilerplate; these costs are the capacities
to the two terminals. What a page calls its parts (nav, article, class names) is
evidence among others, of a learned weight. Blocks that follow each other, and
blocks under one parent element, are tied by smoothness edges, the stronger the
nearer they are in the element tree. The minimum cut, found by maximum flow, is
the labelling of least total cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvion.session import ship, tidy

#: The start of a tag, comment or declaration; and within a tag, its end or the start of a quoted value.
MARKUP = re.compile(r"<(?:(!--)|[!?]|(/?)([A-Za-z][A-Za-z0-9:-]*))")
STOP = re.compile(r"""=\s*["']|>""")
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
TOKEN = re.compile(r"[A-Za-z]+")
#: Elements whose text is never shown as text.
RAW = frozenset("script style noscript template svg math iframe select textarea title".split())
#: Of these, those that end where an element starts that they cannot hold.
BROKEN_OUT = frozenset("svg math select".split())
BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 ul ol li dl table article section main nav header footer aside form blockquote pre body".split())
#: Raw-text elements end only at their own closing tag.
VERBATIM = frozenset("script style textarea title noscript iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Container names and class, id or role words that mark what is not the article.
NOISE = frozenset("nav navigation navbar menu header masthead footer aside sidebar form button notice cookie consent banner ad ads advert advertisement sponsor sponsored promo comment comments reply disqus share social related recommended newsletter subscribe breadcrumb breadcrumbs pagination login signup popup modal copyright toolbar widget".split())
MAIN = frozenset("article main content post entry story body".split())
#: List and table parts that a sibling of their name closes; a paragraph is closed by any block.
SIBLINGS = frozenset("li dt dd tr td th option".split())
#: Pages the classifier learns from, about; learning steps; ridge towards the prior weights; how far the names' word is trusted as a label.
TRAIN_PAGES, LEARN_STEPS, RIDGE, TRUST = 2000, 60, 5.0, 0.97
#: Cost of labelling two neighbouring, or two sibling, blocks differently, at a distance of two in the element tree.
ADJACENT, SIBLING = 0.6, 0.8
FEATURES = ("bias", "noise", "main", "link share", "log length", "sentence", "list item", "heading", "paragraph", "symbols", "before title", "unmarked page")
#: Weights that learning starts from and is drawn to.
PRIOR = np.array([-0.6, -2.5, 2.5, -3.0, 0.45, 0.8, -0.6, 0.8, 0.9, -1.0, -1.0, 0.0])
#: Features that a page whose names are masked, or one made of plain boxes, does not have.
NAMES = [FEATURES.index(f) for f in ("noise", "main")]
TAGS = [FEATURES.index(f) for f in ("list item", "heading", "paragraph", "before title")]


def tag_end(page: str, at: int) -> tuple[int, int]:
    """Where a tag's attributes end and where the page goes on. As in a browser, a value in quotes may hold ">", and a tag or value that never ends takes the rest of the page."""
    while (m := STOP.search(page, at)) and m[0] != ">":
        close = page.find(m[0][-1], m.end())
        if close < 0:
            return len(page), len(page)
        at = close + 1
    return (m.start(), m.end()) if m else (len(page), len(page))


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    #: What its tag, class, id and role say of it.
    noise: bool = False
    main: bool = False
    chars: int = 0


@dataclass
class Block:
    tag: str
    element: int
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""
    noise: bool = False
    main: bool = False


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks of text in page order, one for each run of text between block tags, white space made single; and the block elements.

    Time and space are linear in the page, however deep or broken its tags are:
    every element is opened once and closed once, and a closing tag without an
    open element costs one look-up.
    """
    elements = [Element("", 0, 0)]
    out: list[Block] = []
    # Open elements by tag, how many of each are open, and where in the stack the block elements stand (with their numbers).
    stack: list[str] = []
    opened: Counter = Counter()
    holders: list[tuple[int, int]] = [(-1, 0)]
    at, hidden, current = 0, 0, None

    def text(raw: str) -> None:
        nonlocal current
        if not raw or hidden:
            return
        if current is None:
            if raw.isspace():
                return
            element = holders[-1][1]
            current = Block(elements[element].tag, element)
            out.append(current)
        decoded = html.unescape(raw) if "&" in raw else raw
        current.parts.append(decoded)
        if opened["a"]:
            current.link_chars += len(decoded)

    def close_down_to(size: int) -> None:
        nonlocal hidden
        while len(stack) > size:
            name = stack.pop()
            opened[name] -= 1
            hidden -= name in RAW
        while holders[-1][0] >= size:
            holders.pop()

    def last_open(name: str) -> int:
        k = len(stack) - 1
        while stack[k] != name:
            k -= 1
        return k

    size = len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        if m[3] is None:
            mark = "-->" if m[1] else ">"
            end = page.find(mark, m.end() - 2 * bool(m[1]))
            at = end + len(mark) if end >= 0 else size
            continue
        stop, at = tag_end(page, m.end())
        name, closing, attributes = m[3].lower(), bool(m[2]), page[m.end() : stop]
        if name == "br":
            text(" ")
            continue
        if name not in INLINE:
            current = None
        if closing:
            if opened[name]:
                close_down_to(last_open(name))
            continue
        if name in VERBATIM:
            end = re.compile(rf"</{name}\s*>|</{name}\Z", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in INLINE:
            stack.append(name)
            opened[name] += 1
            continue
        for raw in BROKEN_OUT:
            if opened[raw] and name in BLOCKS:
                close_down_to(last_open(raw))
        place, own = holders[-1]
        if elements[own].tag == "p" and own or (elements[own].tag == name and name in SIBLINGS):
            close_down_to(place)
        words = {w.lower() for a in ATTRIBUTE.findall(attributes) for w in TOKEN.findall("".join(a))} if attributes else set()
        parent = holders[-1][1]
        words.add(name)
        # The page's own frame is neither; a heading part inside the article is told apart later.
        framed = name in ("html", "body")
        elements.append(Element(name, parent, elements[parent].depth + 1, not framed and bool(words & NOISE), not framed and bool(words & MAIN)))
        holders.append((len(stack), len(elements) - 1))
        stack.append(name)
        opened[name] += 1
        hidden += name in RAW
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    out = [b for b in out if b.text]
    name_parts(out, elements)
    return out, elements


def name_parts(blocks: list[Block], elements: list[Element]) -> None:
    """Sets ``noise`` and ``main`` of each block by the innermost element around it that has a name.

    What holds the page's main element (the largest one named so and not as
    noise, or else the first title, or else the longest block) is a frame: its
    own noise words (has-sidebar, a page-wide form) say nothing.
    """
    for b in blocks:
        elements[b.element].chars += len(b.text)
    for e in reversed(elements[1:]):
        elements[e.parent].chars += e.chars
    named = [i for i, e in enumerate(elements) if e.main and not e.noise and e.chars]
    if named:
        at = max(named, key=lambda i: (elements[i].chars, -i))
        frames = {elements[at].parent}
    elif blocks:
        best = next((b for b in blocks if b.tag == "h1"), None) or max(blocks, key=lambda b: len(b.text))
        frames = {best.element}
    else:
        return
    at = next(iter(frames))
    while at:
        frames.add(at := elements[at].parent)
    state: list[tuple[bool, bool]] = []
    for i, e in enumerate(elements):
        noise, main = state[e.parent] if i else (False, False)
        if e.noise and i not in frames and not (e.tag == "header" and main):
            noise, main = True, False
        elif e.main and not e.noise:
            noise, main = False, True
        state.append((noise, main))
    for b in blocks:
        b.noise, b.main = state[b.element]


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    rows = []
    title = next((i for i, b in enumerate(blocks) if b.tag == "h1"), 0)
    unmarked = not any(b.tag == "p" for b in blocks)
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        rows.append((
            1.0, b.noise, b.main, min(1.0, b.link_chars / n), math.log1p(words) - 1.5, b.text[-1] in ".!?:;\"')”»…", b.tag in ("li", "dd", "dt", "td"), b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
            b.tag in ("p", "blockquote", "pre"), min(1.0, 10 * sum(map(b.text.count, "|©·»›{}=<>")) / n), i < title, unmarked,
        ))
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels that minimise the sum of -gain over blocks called content plus the weights of edges that are cut.

    A block whose gain outweighs all its remaining edges has its label in every
    minimum; those are settled first and their edges become gains of their
    neighbours. What is left goes to a maximum flow by shortest augmenting paths.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    ties = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(gain[i]) < ties[i]:
            continue
        label[i] = gain[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                gain[j] += w if label[i] else -w
                ties[j] -= w
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        room: list[dict[int, float]] = [{} for _ in range(n + 2)]
        for i in rest:
            for j, w in near[i].items():
                if label[j] is None:
                    room[i][j] = room[i].get(j, 0.0) + w
            if gain[i] > 0:
                room[n][i], room[i][n] = gain[i], 0.0
            else:
                room[i][n + 1], room[n + 1][i] = -gain[i], 0.0
        reached = maximum_flow(room, n, n + 1)
        for i in rest:
            label[i] = i in reached
    return [bool(x) for x in label]


def maximum_flow(room: list[dict[int, float]], source: int, sink: int, least: float = 1e-12) -> dict[int, int]:
    """Fills ``room`` with a maximum flow by blocking flows along shortest paths; returns what the source still reaches, with distances."""
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            x = queue.popleft()
            for y, c in room[x].items():
                if c > least and y not in level:
                    level[y] = level[x] + 1
                    queue.append(y)
        if sink not in level:
            return level
        ways = {x: iter(list(room[x])) for x in level}
        path = [source]
        while path:
            x = path[-1]
            if x == sink:
                push = min(room[a][b] for a, b in pairwise(path))
                full = None
                for k, (a, b) in enumerate(pairwise(path)):
                    room[a][b] -= push
                    room[b][a] = room[b].get(a, 0.0) + push
                    if full is None and room[a][b] <= least:
                        full = k
                del path[full + 1 :]
                continue
            onward = next((y for y in ways[x] if level.get(y) == level[x] + 1 and room[x][y] > least), None)
            if onward is None:
                path.pop()
            else:
                path.append(onward)


def smoothness(blocks: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between each block and the next under the same parent, weaker with their distance in the tree."""

    def nearness(a: int, b: int) -> float:
        steps = 0
        # Far apart is far apart: the walk up both sides ends after eight steps.
        while a != b and steps < 8:
            if elements[a].depth >= elements[b].depth:
                a = elements[a].parent
            else:
                b = elements[b].parent
            steps += 1
        return 2 / max(2, steps)

    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT * nearness(blocks[i - 1].element, b.element)))
        parent = elements[b.element].parent
        if parent in last:
            edges.append((last[parent], i, SIBLING * nearness(blocks[last[parent]].element, b.element)))
        last[parent] = i
    return edges


def extract(page: str | None, weights: np.ndarray) -> str:
    """The text of the blocks that the minimum cut calls content, joined by line feeds."""
    blocks, elements = blocks_of(page) if page else ([], [])
    if not blocks:
        return ""
    content = minimum_cut((features(blocks) @ weights).tolist(), smoothness(blocks, elements))
    return "\n".join(b.text for b, c in zip(blocks, content, strict=True) if c)


def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to counted feature rows: the label is the names' word, where they have one."""
    for batch in batches:
        counted: dict[tuple, int] = {}
        for page in batch.column(0).to_pylist():
            blocks = blocks_of(page)[0]
            for b, row in zip(blocks, features(blocks), strict=True):
                if b.noise or b.main:
                    key = (not b.noise, *(round(float(x), 1) for x in row))
                    counted[key] = counted.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([list(map(float, k)) for k in counted], pa.list_(pa.float64())), pa.array(list(counted.values()), pa.int64())], names=["row", "n"])


def fit_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", train_pages: int = TRAIN_PAGES, max_rows: int = 50_000) -> np.ndarray:
    """Logistic weights from about ``train_pages`` pages, chosen by a hash of the id.

    Pages that name their parts (article, nav, footer, ...) label their own
    blocks, and the label is trusted to a share of TRUST. Every block is shown
    three times, whole, with its names masked and with its own tag masked too, so
    the other features learn to do without and a name's weight stays what the
    trust is worth. The
    driver sees at most ``max_rows`` distinct rounded feature rows with counts.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).cast("string").alias("html")).where("html is not null")
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_000))
    share = max(1, int(1_000_000 * min(1.0, train_pages / max(1, rows.count()))))
    counted = rows.where(draw < share).select("html").mapInArrow(tidy(moments), "row array<double>, n long").groupBy("row").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "row").limit(max_rows).collect()
    return learn(np.array([r["row"] for r in counted]), np.array([r["n"] for r in counted], dtype=float)) if counted else PRIOR.copy()


def learn(table: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's steps, from rows of a label and FEATURES, with counts."""
    masked, boxes = table[:, 1:].copy(), table[:, 1:].copy()
    masked[:, NAMES] = 0.0
    boxes[:, NAMES + TAGS] = 0.0
    boxes[:, FEATURES.index("unmarked page")] = 1.0
    x = np.concatenate([table[:, 1:], masked, boxes])
    y = np.tile(np.where(table[:, 0] > 0, TRUST, 1 - TRUST), 3)
    n = np.tile(n * 2000 / n.sum(), 3)
    w = PRIOR.copy()
    for _ in range(LEARN_STEPS):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (n * (y - p)) - RIDGE * (w - PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


def main_text(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null, empty or textless page gives an empty text. Malformed pages are
    read as far as their tags go: unclosed elements end with the page, and
    closing tags of elements that are not open are passed over.
    Repeated rows get equal results; an empty table gives no rows; other
    columns are ignored.
    """
    ship(pages.sparkSession)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(tidy(extracted), f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Learn the weights from a sample of ``pages``, then extract every page."""
    return main_text(pages, fit_weights(pages))
