"""Main text of web pages by minimum-cut labelling.

A page becomes text blocks in page order. A linear classifier gives each block its cost of being content and of being boilerplate; these are the
capacities to the two terminals. Neighbouring blocks, and blocks of the same parent, are joined by edges that cost something to cut.
The maximum flow separates the two labels at least total cost; blocks on the content side are the text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from delaylake.llm.shared import col
from delaylake.llm.words import chunks

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# An opening element ends an open one of these kinds, up to a container.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN = frozenset("script style noscript template iframe svg head title textarea button select option".split())
AWAY = frozenset("nav footer aside form menu dialog".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|</?\Z|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
SPACES = re.compile(r"\s+")
NAMES = re.compile(r"[a-z]+|\d+")
# Names of classes, ids and roles that mark parts beside the text.
SIDE = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay "
    "sidebar aside side menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer foot related recommended recommend share sharing social "
    "newsletter subscribe subscription signup login comment comments reply replies discussion disqus toolbar widget widgets copyright search skip toc tags complementary contentinfo".split()
)
MAIN = frozenset("article content main post entry story body text".split())

# Weights of the classifier in log odds for content, set by hand; capacities are in thousandths. The longest plain block has 3.6, and a mark
# beside the text must outweigh that together with a heading and both its edges: 8 for names, which are guesses, 9 for elements.
BIAS, PER_WORD, WORDS_MOST = -0.2, 0.08, 40
SENTENCE, LINKED, IN_ARTICLE, IN_MAIN, HEADING = 0.6, -4.0, 5.0, 2.0, 1.0
IN_AWAY, IN_SIDE, IN_HEADER = -9.0, -8.0, -6.0
NEIGHBOUR, SIBLING = 0.35, 0.35
SCALE = 1000


@dataclass
class Block:
    """A run of text between block boundaries and what stood around it."""

    parent: int
    article: bool
    main: bool
    away: bool
    side: bool
    header: bool
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class Open:
    """An open element: its number, and what it and its ancestors say."""

    name: str
    number: int
    article: bool = False
    main: bool = False
    away: bool = False
    side: bool = False
    header: bool = False
    hidden: bool = False
    link: bool = False


def marks(name: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id or role mark a side part, a main part, or a hidden element."""
    side = main = hidden = False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif key == "hidden":
            hidden = True
        elif key == "aria-hidden":
            hidden |= value == "true"
        else:
            names = set(NAMES.findall(value))
            side |= bool(names & SIDE)
            main |= bool(names & MAIN)
    return side, main and not side, hidden


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, without scripts, styles, comments and hidden parts."""
    stack = [Open("", 0)]
    out: list[Block] = []
    block: Block | None = None
    number = at = 0

    def write(text: str) -> None:
        nonlocal block
        top = stack[-1]
        if top.hidden or not text:
            return
        if block is None:
            if not text.strip():
                return
            holder = next((o for o in reversed(stack) if o.name in BLOCK), stack[0])
            block = Block(holder.number, top.article, top.main, top.away, top.side, top.header, any(o.name in HEADINGS for o in stack))
            out.append(block)
        block.parts.append(text)
        if top.link:
            block.linked += len(text.split())

    def close(upto: int) -> None:
        nonlocal block
        if any(o.name in BLOCK for o in stack[upto:]):
            block = None
        del stack[upto:]

    while True:
        m = TAG.search(page, at)
        write(page[at : m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name), 0)
            # The end tag of an inline element does not reach over a block.
            if k and (name in BLOCK or not any(o.name in BLOCK for o in stack[k + 1 :])):
                close(k)
            elif name == "p":
                block = None
            continue
        if name == "br":
            write(" ")
            continue
        if name in BLOCK:
            block = None
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == "p"), 0)
            if k and not any(o.name in ("table", "button") for o in stack[k:]):
                close(k)
        for other in ENDS.get(name, ()):
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].name == other), 0)
            if k and not any(o.name in SCOPE[name] for o in stack[k:]):
                close(k)
        if name in VOID:
            continue
        side, main, hidden = marks(name, m[3])
        top, number = stack[-1], number + 1
        now = Open(
            name, number, top.article or name == "article", top.main or name == "main" or main, top.away or name in AWAY, top.side or (side and name not in ("body", "html", "article", "main")),
            top.header or name == "header", top.hidden or hidden or name in HIDDEN, top.link or name == "a",
        )
        if name in RAW:
            # Up to the end tag, or to the end of the page, nothing inside is markup.
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif not m[3].endswith("/") or name in BLOCK:
            stack.append(now)
    for b in out:
        b.text = SPACES.sub(" ", html.unescape("".join(b.parts))).strip()
    return [b for b in out if b.text]


def odds(b: Block) -> float:
    """Log odds that a block is content."""
    words = len(b.text.split())
    x = BIAS + PER_WORD * min(words, WORDS_MOST) + SENTENCE * (b.text[-1:] in ".!?…\"”") + LINKED * (b.linked / max(1, words)) ** 2
    # What is marked as beside the text takes nothing from the article around it: no length outweighs the mark.
    x += (IN_ARTICLE * b.article + IN_MAIN * b.main) * (not b.side and not b.away) + HEADING * b.heading
    return x + IN_AWAY * b.away + IN_SIDE * b.side + IN_HEADER * (b.header and not (b.article and b.heading))


class Network:
    """A residual network: maximum flow by shortest augmenting levels (Dinic)."""

    def __init__(self, n: int) -> None:
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def join(self, a: int, b: int, there: int, back: int) -> None:
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def levels(self, source: int) -> list[int]:
        level, queue = [-1] * len(self.edges), deque([source])
        level[source] = 0
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                if self.room[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Nodes that residual edges still reach from the source once the flow is maximal."""
        while (level := self.levels(source))[sink] >= 0:
            tried = [0] * len(self.edges)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    push = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= push
                        self.room[e ^ 1] += push
                    path, a = [], source
                    continue
                while tried[a] < len(self.edges[a]):
                    e = self.edges[a][tried[a]]
                    if self.room[e] > 0 and level[self.to[e]] == level[a] + 1:
                        break
                    tried[a] += 1
                if tried[a] < len(self.edges[a]):
                    path.append(e)
                    a = self.to[e]
                elif path:
                    a = self.to[path.pop() ^ 1]
                    tried[a] += 1
                else:
                    break
        return [x >= 0 for x in level]


def content(blocks: list[Block]) -> list[bool]:
    """The label of each block at least total cost."""
    n = len(blocks)
    parents = {p: n + k for k, p in enumerate(dict.fromkeys(b.parent for b in blocks))}
    net = Network(n + len(parents) + 2)
    source, sink = n + len(parents), n + len(parents) + 1
    near, kin = int(NEIGHBOUR * SCALE), int(SIBLING * SCALE)
    for k, b in enumerate(blocks):
        x = int(odds(b) * SCALE)
        # Only the difference of the two costs matters for the cut.
        if x > 0:
            net.join(source, k, x, 0)
        elif x < 0:
            net.join(k, sink, -x, 0)
        if k:
            net.join(k - 1, k, near, near)
        net.join(k, parents[b.parent], kin, kin)
    labels = net.source_side(source, sink)[:n]
    if any(labels):
        return labels
    # A page of a few words, or one that is marked as a whole: what bears no mark, else what stands in an article.
    plain = [not (b.side or b.away or b.header) and b.linked < max(1, len(b.text.split())) for b in blocks]
    return plain if any(plain) else [(b.article or b.main) and not b.away for b in blocks]


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, content(blocks), strict=True) if keep) if blocks else ""


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """One row per page: id and text, the content blocks in page order, parted by an empty line; white space in a block is one space.

    Whole pages are read. Null, empty and textless pages give an empty text; broken markup is read as far as it goes; repeated rows
    give repeated results, and rows without id are rows like others. An empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(p) if p else "" for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    url = col("url").cast("string") if "url" in pages.columns else col(id_col).cast("string")
    return pages.select(col(id_col).cast("long").alias("id"), url.alias("url"), col(html_col).alias("html")).mapInArrow(run, "id long, url string, text string")
