"""Main text of web pages by minimum-cut labelling.

A page becomes its text blocks in page order, each with its chain of open
elements. Neighbouring blocks of one parent and one kind form a node. A linear
classifier over markup hints and text shape gives every node the cost of
calling it content and of calling it boilerplate: the capacities to the two
terminals. Adjacent nodes, and nodes of the same parent, are joined by edges
whose capacity falls with their distance in the tree. The minimum cut (Dinic's
maximum flow) splits the nodes into content and boilerplate.

Defined cases: NULL or empty html has empty text; markup may be broken or cut
off anywhere (an unfinished tag at the end is dropped, open elements end with
the page); repeated rows map row by row; an empty table gives an empty table;
a column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
DROPPED = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CLOSED_BY = {"p": frozenset("p".split()), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}), "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"})}
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th ul".split())

# Markup hints: elements and words of class, id and role.
BOILER_TAGS = frozenset("nav footer aside form menu dialog button head".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies disqus feedback footer form gdpr login menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget alert complementary contentinfo".split()
)
# Words that name parts of pages and also what articles are about or made for:
# evidence that content hints and prose can outweigh.
WEAK_WORDS = frozenset("search share sharing social widget toolbar feedback login signup alert sponsor".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
CONTENT_WORDS = frozenset("article content entry main post story text body".split())
NOTICE = re.compile(r"©|all rights reserved|cookie|newsletter|subscribe|sign (?:in|up)|log in|advertisement|privacy policy|terms of (?:use|service)", re.I)

# Weights of the classifier, in the unit of a terminal's capacity.
W_BOILER_HINT, W_WEAK_HINT, W_CONTENT_HINT = 12.0, 5.0, 4.0
W_LINKS, W_PROSE, W_SHORT, W_HEADING, W_NOTICE = 3.0, 2.0, 0.5, 1.0, 2.0
# Capacities of the smoothness edges.
W_ADJACENT, W_SAME_PARENT = 2.0, 1.5


class Element:
    __slots__ = ("boiler", "content", "depth", "parent", "tag", "weak")

    def __init__(self, tag: str, parent: Element | None, attributes: str) -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.boiler = bool(parent and parent.boiler)
        self.weak = bool(parent and parent.weak)
        self.content = bool(parent and parent.content)
        words: set[str] = set()
        if attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role"):
                    words.update(WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
                elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    self.boiler = True
        if tag in ("html", "body"):
            return
        layout = words & CONTENT_WORDS and words & {"with", "has", "no"}
        if tag in BOILER_TAGS or words & (BOILER_WORDS - WEAK_WORDS) and not layout:
            self.boiler = True
        elif (tag == "header" or words & HEADER_WORDS) and not self.content:
            self.boiler = True
        else:
            self.weak |= bool(words & WEAK_WORDS) and not layout
            self.content |= tag in CONTENT_TAGS or bool(words & CONTENT_WORDS)


def blocks(html: str) -> list[tuple[str, Element, str, int]]:
    """(text, parent element, block's tag, characters inside links) in page order."""
    out: list[tuple[str, Element, str, int]] = []
    root = Element("html", None, "")
    stack = [root]
    pieces: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked, in_link
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                top = stack[-1]
                leaf = top.tag not in SCOPES and top.parent is not None
                out.append((text, top.parent if leaf else top, top.tag if leaf else "", linked))
        linked, in_link = 0, False

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        to = m.start() if m else n
        if to > at:
            text = unescape(html[at:to])
            pieces.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag or html[at - 1] != ">":
            continue
        tag = tag.lower()
        if tag == "a":
            in_link = not closing
            continue
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                pieces.append(" ")
            continue
        if tag in DROPPED:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else n
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES and tag not in SCOPES:
                    break
            continue
        shut = CLOSED_BY.get(tag, CLOSED_BY["p"])
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in shut:
                del stack[k:]
            elif stack[k].tag in SCOPES and stack[k].tag not in ("td", "th"):
                break
        if tag not in ("html",):
            stack.append(Element(tag, stack[-1], attributes))
    flush()
    return out


def costs(block: tuple[str, Element, str, int]) -> tuple[float, float]:
    """(cost of calling it boilerplate, cost of calling it content)."""
    text, parent, tag, linked = block
    content = boiler = 0.0
    if parent.boiler:
        boiler += W_BOILER_HINT
    else:
        boiler += W_WEAK_HINT * parent.weak
        content += W_CONTENT_HINT * parent.content
    if linked > 0.5 * len(text):
        boiler += W_LINKS
    words = text.count(" ") + 1
    if words >= 10 and text[-1] in ".!?:;\"'”»)":
        content += W_PROSE
    elif words < 4:
        boiler += W_SHORT
    if tag in ("h1", "h2", "h3"):
        content += W_HEADING
    if words < 30 and NOTICE.search(text):
        boiler += W_NOTICE
    return content, boiler


def tree_distance(a: Element, b: Element) -> int:
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def source_side(terminals: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: whether each node stays with the source. A terminal pair is
    (capacity from the source, capacity to the sink); edges go both ways."""
    n = len(terminals)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            cap.append(c)

    for v, (up, down) in enumerate(terminals):
        both = min(up, down)  # flows straight through
        if up > both:
            link(s, v, up - both, 0.0)
        elif down > both:
            link(v, t, down - both, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = [s]
        for x in queue:
            for e in out[x]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[v] >= 0 for v in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        x = s
        while True:
            if x == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                x = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[x] < len(out[x]):
                e = out[x][nxt[x]]
                if cap[e] > 1e-9 and level[to[e]] == level[x] + 1:
                    break
                nxt[x] += 1
            else:
                if x == s:
                    break
                e = path.pop()
                x = to[e ^ 1]
                nxt[x] += 1
                continue
            path.append(e)
            x = to[e]


def main_text(html: str | None) -> str:
    """The main text of a page: content blocks in order, one per line."""
    found = blocks(html or "")
    if not found:
        return ""
    node_of: list[int] = []
    terminals: list[list[float]] = []
    parents: list[Element] = []
    last = None
    for block in found:
        up, down = costs(block)
        kind = (id(block[1]), up > down)
        if kind != last:
            terminals.append([0.0, 0.0])
            parents.append(block[1])
            last = kind
        terminals[-1][0] += up
        terminals[-1][1] += down
        node_of.append(len(terminals) - 1)
    edges = [(k, k + 1, W_ADJACENT / (1 + tree_distance(parents[k], parents[k + 1]))) for k in range(len(parents) - 1)]
    seen: dict[int, int] = {}
    for k, p in enumerate(parents):
        if id(p) in seen:
            edges.append((seen[id(p)], k, W_SAME_PARENT))
        seen[id(p)] = k
    keep = source_side([(a, b) for a, b in terminals], edges)
    return "\n".join(block[0] for block, k in zip(found, node_of, strict=True) if keep[k])


def extract(df: DataFrame, html_column: str = "html") -> DataFrame:
    """Replace the html column by ``text``, the main text; other columns pass through."""
    keep = [c for c in df.columns if c not in (html_column, "text")]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=schema.names)

    return df.select(*keep, html_column).mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points."""
    return extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.char_length("text").cast("long"))
