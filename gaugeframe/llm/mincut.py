"""Main text of web pages by minimum-cut labelling of their blocks.

A page is a sequence of text blocks.  A classifier gives every block a cost for calling it
content and one for calling it boilerplate; these are the capacities to the two terminals.
Neighbours on the page, and blocks of the same container, have edges whose capacity is the
cost of labelling them differently.  The minimum cut, found as a maximum flow, is the
cheapest labelling; the blocks on the content side are the text.  Every page is a small
problem of its own, so pages are processed where they are read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math canvas object".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
# An element of the first kind ends an open element of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
ENDS |= {"th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select div article section main nav body".split())

# Elements and marks of boilerplate.
OUTSIDE = frozenset("nav aside footer menu button select head title".split())
# Elements that are boilerplate as the words below are, unless they hold the page itself.
MARKED = frozenset("form dialog fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices "
    "notification popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "recommendations comment comments disqus reply replies widget pagination pager toolbar search copyright".split()
)
INSIDE = frozenset("article main".split())
INSIDE_WORDS = frozenset("article content post entry story main".split())

# Costs and capacities, in the same unit.
SURE = 400
# A marked element with so many times the unmarked text beside it, and half of all, is the page.
MOST = 4
IN_ARTICLE, OUT_OF_ARTICLE = 60, 40
NEIGHBOURS, SAME_PARENT, SAME_SECTION = 3, 8, 5

_ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Block:
    text: str
    score: int
    parent: int
    section: int


@dataclass
class _Element:
    name: str
    number: int
    outside: bool
    inside: bool
    bonus: int
    section: int
    # Numbers of the marked elements around, and of the outermost article.
    marks: tuple[int, ...] = ()
    article: int = 0


def blocks_of(html: str) -> list[Block]:
    """Text blocks in page order, white space and character references resolved, with their scores."""
    stack = [_Element("", 0, False, False, 0, 0)]
    blocks: list[tuple[Block, _Element, float]] = []
    # Marks around each outermost article.
    articles: list[tuple[int, ...]] = []
    pieces: list[str] = []
    linked = in_link = number = 0
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            top = stack[-1]
            if text:
                blocks.append((Block(text, 0, top.number, top.section), top, linked / sum(map(len, pieces))))
            pieces, linked = [], 0

    while at < end:
        start = html.find("<", at)
        text = html[at : start if start >= 0 else end]
        if text:
            pieces.append(text)
            linked += len(text) if in_link else 0
        if start < 0:
            break
        tag = _TAG.match(html, start)
        if tag is None:
            at = _skip(html, start)
            if at == start:
                pieces.append("<")
                at += 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if name in RAW and not tag[1]:
            if not tag[3].endswith("/"):
                close = re.compile(rf"</{name}[^a-z0-9]", re.IGNORECASE).search(html, at)
                at = close.start() if close else end
            continue
        if name == "a":
            in_link = 0 if tag[1] else 1
        if name == "br":
            pieces.append(" ")
        if name not in BLOCK:
            continue
        flush()
        if tag[1]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if place:
                del stack[place:]
            continue
        if stack[-1].name == "p" or (stack[-1].name == "head" and name not in ("title", "head")):
            stack.pop()
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in ENDS.get(name, ()):
                del stack[i:]
                break
            if stack[i].name in SCOPE:
                break
        if name not in VOID:
            number += 1
            stack.append(_opened(name, tag[3], number, stack[-1]))
            if stack[-1].article == number and not stack[-1].outside:
                articles.append(stack[-1].marks)
    flush()
    lifted = _lifted(blocks, articles)
    found = False
    for block, element, link_share in blocks:
        outside = element.outside or not lifted.issuperset(element.marks)
        block.score = -SURE if outside else _score(block.text, element, link_share)
        found |= element.inside and not outside
    for block, element, _ in blocks if found else ():
        block.score -= 0 if element.inside else OUT_OF_ARTICLE
    return [block for block, _, _ in blocks]


def _lifted(blocks: list[tuple[Block, _Element, float]], articles: list[tuple[int, ...]]) -> set[int]:
    """Marked elements that hold the only article or most of the page's text; their marks say nothing."""
    lifted = set(articles[0]) if len(articles) == 1 else set()
    whole = sum(len(block.text) for block, _, _ in blocks)
    free = article = 0
    held: dict[int, int] = {}
    for block, element, _ in blocks:
        if element.outside:
            continue
        if lifted.issuperset(element.marks):
            free += len(block.text)
            article |= element.inside
        for mark in element.marks:
            held[mark] = held.get(mark, 0) + len(block.text)
    if article:
        return lifted
    # From the outermost one on: text in a lifted element is free for those within it.
    for mark in sorted(held):
        if mark not in lifted and held[mark] >= MOST * free and 2 * held[mark] >= whole:
            lifted.add(mark)
            inner = (b for b, e, _ in blocks if not e.outside and mark in e.marks and lifted.issuperset(e.marks))
            free += sum(len(b.text) for b in inner)
    return lifted


def _skip(html: str, start: int) -> int:
    """End of a comment, declaration or broken tag; ``start`` if the bracket is text."""
    if html.startswith("<!--", start):
        close = html.find("-->", start + 4)
        return close + 3 if close >= 0 else len(html)
    if start + 1 < len(html) and (html[start + 1] in "!?/" or html[start + 1].isalpha()):
        close = html.find(">", start)
        return close + 1 if close >= 0 else len(html)
    return start


def _opened(name: str, attributes: str, number: int, parent: _Element) -> _Element:
    outside = parent.outside or name in OUTSIDE or (name == "header" and not parent.inside)
    inside = parent.inside or name in INSIDE
    bonus = parent.bonus
    marked = name in MARKED
    if attributes and name not in ("html", "body"):
        words: set[str] = set()
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                words |= {w.lower() for w in _WORD.findall(value)}
            outside |= key == "role" and value.lower() in OUTSIDE_ROLES
            outside |= key == "aria-hidden" and value.lower() == "true"
            outside |= key == "style" and "display:none" in value.replace(" ", "").lower()
        marked |= bool(words & OUTSIDE_WORDS)
        bonus += 10 if words & INSIDE_WORDS else 0
    section = parent.section if name in ("p", "li", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6") else number
    marks = (*parent.marks, number) if marked else parent.marks
    article = parent.article or (number if name in INSIDE else 0)
    return _Element(name, number, outside, inside, bonus, section, marks, article)


def _score(text: str, element: _Element, link_share: float) -> int:
    """How much more it costs to call the block boilerplate than to call it content."""
    score = -10 + min(len(text.split()), 20) - round(40 * link_share)
    score += 5 if text[-1] in ".!?:;\"')" else 0
    score += IN_ARTICLE if element.inside else 0
    score += 15 if element.name in ("p", "blockquote", "pre") else 0
    score += 8 if element.name in ("h1", "h2", "h3", "h4", "h5", "h6") else 0
    return score + min(element.bonus, 20)


def content(blocks: list[Block]) -> list[bool]:
    """The cheapest labelling: True for content."""
    n = len(blocks)
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            same = blocks[i - 1].parent == block.parent
            edges[i - 1, i] = SAME_PARENT if same else NEIGHBOURS
        before = last.get(block.section)
        if before is not None:
            edges[before, i] = edges.get((before, i), 0) + SAME_SECTION
        last[block.section] = i
    return minimum_cut([b.score for b in blocks], edges) if n else []


def minimum_cut(scores: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes are on the source side of a minimum cut.

    A positive score is a capacity from the source, a negative one to the sink; edges have
    the same capacity both ways.  The flow is made by shortest paths, level by level.
    """
    n = len(scores)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    head: list[int] = []
    room: list[int] = []

    def add(u: int, v: int, there: int, back: int) -> None:
        graph[u].append(len(head))
        graph[v].append(len(head) + 1)
        head.extend((v, u))
        room.extend((there, back))

    for i, score in enumerate(scores):
        if score > 0:
            add(source, i, score, 0)
        elif score < 0:
            add(i, sink, -score, 0)
    for (u, v), capacity in edges.items():
        add(u, v, capacity, capacity)

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if room[e] > 0 and level[head[e]] < 0:
                    level[head[e]] = level[u] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        arc = [0] * (n + 2)
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(k for k, e in enumerate(path) if room[e] == 0)
                u = head[path[cut] ^ 1]
                del path[cut:]
                continue
            while arc[u] < len(graph[u]):
                e = graph[u][arc[u]]
                if room[e] > 0 and level[head[e]] == level[u] + 1:
                    break
                arc[u] += 1
            if arc[u] < len(graph[u]):
                path.append(graph[u][arc[u]])
                u = head[path[-1]]
            elif path:
                level[u] = -1
                u = head[path.pop() ^ 1]
            else:
                break


def main_text(html: str) -> str:
    """The content blocks of a page, joined by two line feeds."""
    blocks = blocks_of(html)
    return "\n\n".join(b.text for b, kept in zip(blocks, content(blocks), strict=True) if kept)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    One row per input row, repeated rows included.  A null or empty page, and one without
    content, has an empty text; null ids and addresses are passed on; other columns are
    ignored.
    """
    source = pages.select(pages[id_column], pages[url_column], pages[html_column])
    kinds = [f.dataType.simpleString() for f in source.schema]
    names = [id_column, url_column, "text", "n_chars"]
    schema = f"`{id_column}` {kinds[0]}, `{url_column}` {kinds[1]}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([len(t) for t in texts], pa.int64())], names)

    return source.mapInArrow(run, schema)
