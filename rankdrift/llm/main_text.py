"""Main text of web pages by minimum-cut labelling.

A page becomes a sequence of text blocks, parted by block-level tags. What speaks for a block being content or boilerplate
are log odds of two kinds. A logistic regression over the block itself (length, share of links, ends of sentences, place
on the page, its neighbours' length) is fitted on a bounded sample of the pages (``MOST_FITTED``), with blocks inside and
outside of elements such as ``article`` and ``nav`` as examples; so it also judges pages without such elements. Markup
adds fixed odds: elements and roles, words of ``class`` and ``id`` (weaker), and words by which readers' comments,
adverts and notices introduce themselves, whatever their names.

The sum is what it costs to label the block against it: the capacity of its edge to the source or the sink. Neighbours in
reading order, and next blocks below the same parent, are joined by edges. Their weights are log odds, too: how much
more often than not blocks that lie so far apart in the tree have the same label in the sample. Edges that leave a
marked region weigh little. The cheapest labelling is a minimum cut, found by maximum flow. So a line of two words
goes with its article, though on its own it looks like a menu's. Blocks whose cost outweighs all their edges are
decided beforehand, so the flow runs over the doubtful ones alone.

The text of a block has its white space runs as one space each and character references decoded; content blocks are
joined by one space in page order. Whole pages are read; nothing is dropped or capped but what the labels say.

Defined cases: a null, empty or white page has the empty text. Broken markup is read as far as it goes: unclosed
elements end with their parents. Rows with a null id or url and repeated rows are treated like all others. If the sample
has fewer than ``LEAST_EXAMPLES`` blocks of either kind, ``PLAIN`` takes the place of a fitted model. Other columns
are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdrift.llm.common import batches_of, rows_of, small_batches, table

# Element names of HTML, and words by which sites name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template svg math head title iframe object select datalist canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
MAIN_TAGS = frozenset("article main".split())
SIDE_TAGS = frozenset("nav footer aside form menu dialog button".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
MAIN_WORDS = frozenset("article articlebody body content entry main maincontent post postbody story text".split())
SIDE_WORDS = frozenset(
    "ad adbox ads adslot adsense adunit advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment "
    "commentlist "
    "comments consent cookie cookies copyright discussion disqus footer form gdpr header hidden legal login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion rail reactions recommended related replies reply respond responses search share sharing side sidebar signup skip "
    "social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
#: Short blocks with these words introduce what is not the page's text, in English, French, Spanish and German.
CUES = re.compile(
    r"\b(?:comments?|repl(?:y|ies)|responses?|advertisement|sponsored|promoted|newsletter|subscribe|sign ?up|log ?in|related|read also|"
    r"share this|commentaires?|répondre|réponses?|publicité|sponsorisé|abonnez|connexion|lire aussi|partager|comentarios?|responder|"
    r"respuestas?|publicidad|patrocinado|suscríbe\w*|iniciar sesión|relacionad\w+|compartir|kommentare?|antworten?|anzeige|werbung|"
    r"gesponsert|abonnieren|anmelden|mehr zum thema|teilen|says|\d+ (?:minutes?|hours?|days?|weeks?) ago|il y a \d+|hace \d+|vor \d+)\b",
    re.IGNORECASE,
)
NOTICE = re.compile(r"\bcookies?\b.*\b(?:use|accept|consent|utilis\w+|usa\w*|verwend\w+|akzept\w+|acept\w+)|\b(?:use|accept|utilis\w+|usa\w*|verwend\w+) .*\bcookies?\b", re.I | re.S)
CUE_WORDS = 8
#: Log odds of markup: inside article and main, words that name main parts, elements and words of other parts, outside of a
#: main element where the page has one, and cues.
IN_MAIN, NAMED_MAIN, IN_SIDE, NAMED_SIDE, OUTSIDE_MAIN, CUED = 4.0, 1.5, -8.0, -5.0, -4.0, -4.5
#: Bounds of what the fitted classifier may say.
LEAST_ODDS, MOST_ODDS = -5.0, 3.0
#: Share of its weight that an edge out of a marked region keeps, and the most that an edge weighs.
CROSSING, MOST_EDGE = 0.1, 3.0
#: Distances in the tree that edges are told apart by, the last one standing for all beyond.
DISTANCES = 6
#: Doubtful blocks in a row beyond which those that follow from others are labelled before the flow.
LONG = 300
#: Pages that the model is fitted on, blocks of a page, and the least number of examples of either kind.
MOST_FITTED, MOST_BLOCKS, LEAST_EXAMPLES = 2000, 400, 30
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Names that tell a state of what they are on, such as has-sidebar.
_STATE = re.compile(r"(?:has|is|js|no|not|with|without)[-_]")
OWN_HEADER = frozenset("article entry post story".split())


@dataclass(slots=True)
class Element:
    tag: str
    parent: Element | None
    depth: int
    main: bool
    named_main: bool
    side: bool
    named_side: bool
    unseen: bool
    region: Element | None = None


@dataclass(slots=True)
class Block:
    parent: Element
    text: str
    link_share: float
    heading: bool
    cued: bool = False


def _names(value: str) -> set[str]:
    parts = " ".join(name for name in value.split() if not _STATE.match(name))
    return set(_WORD.findall(_CAMEL.sub(" ", parts).lower()))


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._at = Element("", None, 0, False, False, False, False, False)
        self._parts: list[str] = []
        self._linked = self._links = 0
        self._heading = False

    def _flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            at = self._at
            while at.tag in INLINE and at.parent:
                at = at.parent
            self.blocks.append(Block(at, text, min(1.0, self._linked / len(text)), self._heading))
        self._parts, self._linked, self._heading = [], 0, False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "hr"):
            self._parts.append(" ")
        if tag in VOID:
            return
        if tag not in INLINE:
            self._flush()
            if tag in ENDS_P:
                self._close("p")
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self._close(tag, "ul", "ol", "dl", "table")
        if tag == "a":
            self._links += 1
        up, given = self._at, dict(attrs)
        words = _names(f"{given.get('class') or ''} {given.get('id') or ''}") if attrs else set()
        if up.main or words & OWN_HEADER:
            words -= {"header"}  # an article's own, with its title
        role = (given.get("role") or "").lower()
        style = (given.get("style") or "").replace(" ", "").lower()
        gone = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style
        page_header = tag == "header" and not up.main
        side = tag in SIDE_TAGS or role in SIDE_ROLES or page_header or gone
        named_side = bool(words & SIDE_WORDS)
        up_side, up_named = up.side, up.named_side
        if tag in ("body", "html"):
            side = named_side = False  # sites name states of the whole page there
        if tag == "main" or role == "main":
            up_side = up_named = side = named_side = False
        main = tag in MAIN_TAGS or role in ("main", "article") or given.get("itemprop") == "articleBody"
        named_main = bool(words & MAIN_WORDS)
        at = Element(
            tag,
            up,
            up.depth + 1,
            up.main or main,
            up.named_main or named_main,
            up_side or side,
            up_named or named_side,
            up.unseen or tag in UNSEEN,
        )
        at.region = at if main or side or named_side else up.region
        self._at = at

    def _close(self, tag: str, *bounds: str) -> None:
        """End the nearest open element of the name, if there is one before any of the bounds."""
        at = self._at
        while at.parent and at.tag != tag:
            if at.tag in bounds or tag == "p" and at.tag not in INLINE:
                return
            at = at.parent
        if at.parent:
            self._flush()
            self._leave(at)

    def _leave(self, element: Element) -> None:
        while self._at is not element:
            self._links -= self._at.tag == "a"
            self._at = self._at.parent
        self._links -= element.tag == "a"
        self._at = element.parent

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        at = self._at
        while at.parent and at.tag != tag:
            if tag in INLINE and at.tag not in INLINE:
                return
            at = at.parent
        if at.parent:
            self._leave(at)

    def handle_data(self, data: str) -> None:
        if self._at.unseen:
            return
        self._parts.append(data)
        if self._links:
            self._linked += len(data)
        if self._at.tag in ("h1", "h2"):
            self._heading = True

    def close(self) -> None:
        super().close()
        self._flush()


def blocks_of(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    _mark_cued(parser.blocks)
    return parser.blocks


def _below(element: Element, top: Element) -> bool:
    while element.depth > top.depth:
        element = element.parent
    return element is top


def _mark_cued(blocks: list[Block]) -> None:
    """Mark blocks that introduce comments, adverts and notices, and what follows them in the element around them.

    A heading of the first or second level that is none ends what was introduced.
    """
    open_in: list[Element] = []
    for block in blocks:
        while open_in and not _below(block.parent, open_in[-1]):
            open_in.pop()
        short = block.text.count(" ") < CUE_WORDS
        if short and CUES.search(block.text):
            around = block.parent.parent or block.parent
            if not open_in or open_in[-1] is not around:
                open_in.append(around)
        elif block.heading:
            open_in.clear()
        block.cued = bool(open_in) or bool(NOTICE.search(block.text) if len(block.text) < 1000 else None)


def features(blocks: list[Block]) -> np.ndarray:
    """What the classifier sees of each block: nothing of how the page names its parts."""
    n = len(blocks)
    words = np.array([b.text.count(" ") + 1 for b in blocks], float)
    size = np.log1p(words)
    beside = np.zeros(n)
    if n > 1:
        beside[1:] += size[:-1]
        beside[:-1] += size[1:]
        beside[1:-1] /= 2
    place = np.arange(n)
    ends = [b.text[-1] in ".!?…:;\"'»”)" for b in blocks]
    columns = [
        np.ones(n),
        size,
        words <= 3,
        [b.link_share for b in blocks],
        ends,
        [b.heading for b in blocks],
        [b.parent.tag in ("li", "td", "dd", "dt") for b in blocks],
        beside,
        np.minimum(place, n - 1 - place) / max(n, 1),
        [b.text.startswith(("©", "(c)", "Copyright")) for b in blocks],
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1).reshape(n, len(columns))


@dataclass
class Model:
    """``weights`` of the features and of edges by distance in the tree, as log odds."""

    weights: np.ndarray
    edges: np.ndarray

    def odds(self, blocks: list[Block]) -> list[float]:
        """Log odds of each block being content, all evidence taken together."""
        if not blocks:
            return []
        has_main = any(b.parent.main for b in blocks)
        own = np.clip(features(blocks) @ self.weights, LEAST_ODDS, MOST_ODDS)
        return [float(x) + marked(block, has_main) for x, block in zip(own, blocks, strict=True)]


#: For single pages and samples without examples: longer blocks without links are content.
PLAIN = Model(
    np.array([-1.2, 0.7, -0.8, -3.0, 0.4, 1.0, -0.3, 0.15, 0.3, -3.0]), np.array([1.6, 0.8, 0.5, 0.3, 0.2, 0.1, 0.1])
)


def marked(block: Block, has_main: bool) -> float:
    """The log odds that markup and cues add."""
    at = block.parent
    total = CUED if block.cued else 0.0
    if at.side:
        return total + IN_SIDE
    if at.named_side:
        return total + NAMED_SIDE
    if at.main:
        total += IN_MAIN
    elif has_main:
        total += OUTSIDE_MAIN
    return total + NAMED_MAIN * at.named_main


def examples(blocks: list[Block]) -> np.ndarray:
    """1 for blocks of a main element, 0 for those of other named elements, -1 for what can't be told."""
    return np.array(
        [0 if b.parent.side or b.parent.named_side or b.cued else 1 if b.parent.main else -1 for b in blocks], np.int8
    )


def fit(x: np.ndarray, y: np.ndarray, same: np.ndarray, apart: np.ndarray, rounds: int = 25) -> Model:
    """Logistic regression by Newton's method, with a Gaussian prior, and edge weights from counts of neighbours."""
    if min((y == 1).sum(), (y == 0).sum()) < LEAST_EXAMPLES:
        return PLAIN
    weights, prior = PLAIN.weights.copy(), np.full(x.shape[1], 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - prior * weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(prior), slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    # Distances that the sample doesn't have keep their plain weight.
    plain = 1 / (1 + np.exp(-PLAIN.edges))
    odds = np.log((same + 10 * plain) / (apart + 10 * (1 - plain)))
    return Model(weights, np.clip(odds, 0.0, MOST_EDGE))


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a, steps = a.parent, steps + 1
    return steps


def neighbours(blocks: list[Block]) -> Iterator[tuple[int, int, int]]:
    """Pairs of blocks that edges join, with their distance in the tree."""
    last: dict[int, int] = {}
    for k, block in enumerate(blocks):
        if k:
            yield k - 1, k, _distance(blocks[k - 1].parent, block.parent)
        # The next block below the same parent's parent, if others stand between.
        group = id(block.parent.parent or block.parent)
        if last.get(group, k) < k - 1:
            yield last[group], k, _distance(blocks[last[group]].parent, block.parent)
        last[group] = k


def edges_of(blocks: list[Block], model: Model = PLAIN) -> list[tuple[int, int, float]]:
    edges = []
    for a, b, distance in neighbours(blocks):
        crossing = blocks[a].parent.region is not blocks[b].parent.region or blocks[a].cued != blocks[b].cued
        edges.append((a, b, float(model.edges[min(distance, DISTANCES)]) * (CROSSING if crossing else 1.0)))
    return edges


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labels (True: content) with the least sum of |score| of blocks labelled against their score and of cut edges.

    Of several such labellings, the one with the most content. Blocks whose score outweighs all their edges have its
    label in any of them; they part the page into groups of doubtful blocks, each of which has a flow of its own.
    """
    n, scores = len(scores), list(scores)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    open_weight = [sum(w for _, w in own) for own in near]
    label: list[bool | None] = [None] * n
    sure = [k for k in range(n) if abs(scores[k]) > open_weight[k] + 1e-12]

    def decide(ready: deque[int], further: bool) -> None:
        """Label blocks and give their edges' weight to their neighbours; ``further``: also those that this decides."""
        while ready:
            k = ready.popleft()
            if label[k] is not None:
                continue
            label[k] = scores[k] > 0
            for other, w in near[k]:
                if label[other] is None and other not in waiting:
                    scores[other] += w if label[k] else -w
                    open_weight[other] -= w
                    if further and abs(scores[other]) > open_weight[other] + 1e-12:
                        ready.append(other)

    waiting = set(sure)
    for k in sure:
        waiting.discard(k)
        decide(deque([k]), False)
    for group in _groups([k for k in range(n) if label[k] is None], near, label):
        if len(group) > LONG:  # the same labels, in linear time for most of them
            decide(deque(k for k in group if abs(scores[k]) > open_weight[k] + 1e-12), True)
        rest = [k for k in group if label[k] is None]
        number = {k: i for i, k in enumerate(rest)}
        left = [(i, number[b], w) for k, i in number.items() for b, w in near[k] if b in number and k < b]
        for k, content in zip(rest, _flow_labels([scores[k] for k in rest], left) if rest else [], strict=True):
            label[k] = content
    return [bool(x) for x in label]


def _groups(blocks: list[int], near: list[list[tuple[int, float]]], label: list[bool | None]) -> Iterator[list[int]]:
    """The blocks without a label, by what edges connect."""
    seen: set[int] = set()
    for first in blocks:
        if first in seen:
            continue
        group, queue = [], deque([first])
        seen.add(first)
        while queue:
            k = queue.popleft()
            group.append(k)
            for other, _ in near[k]:
                if label[other] is None and other not in seen:
                    seen.add(other)
                    queue.append(other)
        yield sorted(group)


def _flow_labels(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut by Dinic's maximum flow; content is what can't reach the sink any more."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for k, s in enumerate(scores):
        if s > 0:
            join(source, k, s, 0.0)
        elif s < 0:
            join(k, sink, -s, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9

    def levels(start: int, backward: bool) -> list[int]:
        level = [-1] * (n + 2)
        level[start] = 0
        queue = deque([start])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e ^ 1 if backward else e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        return level

    while (level := levels(source, False))[sink] >= 0:
        tried, path, at = [0] * (n + 2), [], source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(i for i, e in enumerate(path) if room[e] <= tiny)
                at = to[path[full] ^ 1]
                del path[full:]
            elif tried[at] < len(out[at]):
                e = out[at][tried[at]]
                if room[e] > tiny and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                else:
                    tried[at] += 1
            elif path:
                at = to[path.pop() ^ 1]
                tried[at] += 1
            else:
                break
    return [x < 0 for x in levels(sink, True)[:n]]


def labels_of(blocks: list[Block], model: Model = PLAIN) -> list[bool]:
    """Which blocks are content."""
    return min_cut(model.odds(blocks), edges_of(blocks, model))


def main_text(html: str | None, model: Model = PLAIN) -> str:
    """The main text of a page."""
    blocks = blocks_of(html or "")
    return " ".join(b.text for b, content in zip(blocks, labels_of(blocks, model), strict=True) if content)


def train(pages: DataFrame, html_col: str = "html", most: int = MOST_FITTED) -> Model:
    """The model of ``most`` pages at most, those with the least hash."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(html_col).cast("string").alias("html")).withColumn("hash", F.xxhash64("html"))
    # Copies of a page count once, so they can't take up the sample. ``most`` numbers.
    chosen = rows.select("hash").distinct().orderBy("hash").limit(most)
    sample = rows.join(F.broadcast(chosen), "hash").groupBy("hash").agg(F.min("html").alias("html"))
    schema = pa.schema([("x", pa.binary()), ("y", pa.binary()), ("pairs", pa.binary())])

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, html in rows_of(batches):
            blocks = blocks_of(html or "")
            y = examples(blocks)
            pairs = np.zeros((2, DISTANCES + 1))
            for a, b, distance in neighbours(blocks):
                if y[a] >= 0 and y[b] >= 0:
                    pairs[int(y[a] != y[b]), min(distance, DISTANCES)] += 1
            told = np.flatnonzero(y >= 0)
            if len(told) > MOST_BLOCKS:
                told = np.sort(np.random.default_rng(len(told)).choice(told, MOST_BLOCKS, replace=False))
            if len(told):
                yield features(blocks)[told].astype("<f4").tobytes(), y[told].tobytes(), pairs.tobytes()

    found = sample.mapInArrow(lambda b: batches_of(seen(b), schema), "x binary, y binary, pairs binary").collect()
    width = len(PLAIN.weights)
    x = np.frombuffer(b"".join(r.x for r in found), "<f4").reshape(-1, width).astype(float)
    y = np.frombuffer(b"".join(r.y for r in found), np.int8).astype(float)
    same, apart = sum((np.frombuffer(r.pairs).reshape(2, -1) for r in found), np.zeros((2, DISTANCES + 1)))
    return fit(x, y, same, apart)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``pages`` with its main texts as ``text_col``, by a model fitted on them unless one is given."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(train(pages, html_col) if model is None else model)

    @F.pandas_udf(T.StringType())
    def extracted(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in column:
            yield pages.map(lambda html: main_text(html, shared.value), na_action=None)

    return pages.withColumn(text_col, extracted(F.col(html_col).cast("string")))


def op5_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
