"""Main text of web pages by consensus of their hosts.

Each page's containers are scored by the running text they hold, and the page votes for the
generalised path of its best one, such as ``body>div.page-#>article``: tags with their classes,
digits replaced. The votes are counted per host in Spark, and every page is extracted again at
its host's winning path. A page that has most of its text elsewhere uses its own best; so do
pages without a host, which have nothing in common.

Votes are combined before the shuffle; a host has one winner, so the join back is small on one
side and is broadcast only after counting, otherwise split by adaptive execution where a host
is hot. Pages are parsed twice and never leave their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.url_rules import url_parts
from pathloom.storage import broadcast_if_small, freeze

BROADCAST_HOSTS = 50_000
NEARLY_ALL = 0.85  # of a page's running text, for its best container
NAMED_SHARE = 0.1  # of a page's running text, for a winner that is named as an article

# Elements whose content is no text of the page, that hold containers, and that end a block.
SKIPPED = frozenset("script style noscript template svg iframe object video audio canvas select button textarea head title datalist map".split())
CONTAINERS = frozenset("body article main section div aside nav header footer form fieldset dialog menu details td th figure ul ol dl table".split())
SCORED = frozenset("body article main section div td".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr caption blockquote pre figcaption hr address summary legend thead tbody tfoot center html".split()) | CONTAINERS

# Elements, roles and words of classes or ids that mark what is not the article.
ASIDE_TAGS = frozenset("nav aside footer menu".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert menu menubar".split())
# These are none either, unless the page is written inside of one.
WRAPPER_TAGS, WRAPPER_ROLES = frozenset("form dialog fieldset".split()), frozenset("form dialog".split())
WRAPPED_TEXT = 200  # characters of running text that make a form without an article more than a form
ASIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored banner cookie cookies consent gdpr notice notices alert
    sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer footnav copyright comment comments commentlist disqus respond reply replies
    share sharing social related recommended promo promotion popup modal overlay newsletter subscribe subscription signup login paywall search toolbar
    pagination pager masthead skip hidden""".split())
HEADER_WORDS = frozenset("header topbar".split())  # these only outside an article
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
# Words that leave a class what the aside word beside them says, and words of a layout's state.
NEUTRAL_WORDS = frozenset("left right top bottom box block bar area list widget site".split())
STATE_WORDS = frozenset("has no not with without is open closed enabled disabled ready active loaded on off".split())
WEAK, STRONG, COMMENT, WRAPPER = 1, 2, 3, 4  # what class words, or the element, say about a container as an aside
GOOD_WORDS = frozenset("article content post entry story main text body".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z) | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)> | <[!?][^>]*>""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in SKIPPED}


@lru_cache(1 << 16)
def _marks(names: str) -> tuple[int, int, frozenset[str]]:
    """How much class words say that a container is an aside, outside an article and inside
    one, and the words."""
    marks, every = [0, 0], set()
    for token in names.split():
        words = {w.lower() for w in _WORDS.findall(token)}
        every |= words
        for inside, signs in enumerate((ASIDE_WORDS | HEADER_WORDS, ASIDE_WORDS)):
            if words & COMMENT_WORDS and not words & STATE_WORDS:
                mark = COMMENT
            elif words & signs:
                others = {w for w in words - signs - NEUTRAL_WORDS if not w.isdigit()}
                mark = WEAK if others & STATE_WORDS or len(others) >= len(words & signs) > 0 else STRONG
            else:
                mark = 0
            marks[inside] = max(marks[inside], mark)
    return marks[0], marks[1], frozenset(every)


class Node:
    """A container: its generalised path, whether it is outside the article, and what it holds.

    ``dropped`` says that its element or role is none of an article; ``mark`` what its class
    words say, which counts only when the text of the whole page is known.
    """

    __slots__ = ("tag", "parent", "path", "dropped", "mark", "aside", "inside", "weight", "text", "chars", "mains", "head")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        outside, within, words = _marks(f"{found.get('class', '')} {found.get('id', '')}") if found else (0, 0, frozenset())
        self.tag, self.parent, self.text, self.chars, self.mains, self.head, self.aside = tag, parent, 0, 0, 0, False, None
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.dropped = parent is not None and parent.dropped
        self.mark = 0
        if tag not in ("body", "article", "main"):
            self.mark = within if self.inside else outside
            if tag in WRAPPER_TAGS or found.get("role", "").lower() in WRAPPER_ROLES:
                self.mark = WRAPPER
            self.dropped = bool(self.dropped or tag in ASIDE_TAGS or (tag == "header" and not self.inside) or found.get("role", "").lower() in ASIDE_ROLES
                                or "hidden" in found or found.get("aria-hidden", "").lower() == "true")
        elif tag != "body" and not self.dropped and within != COMMENT:
            at = self
            while at is not None:
                at.mains += 1
                at = at.parent
        label = tag + "".join(sorted("." + re.sub(r"\d+", "#", c.lower()) for c in found.get("class", "").split()))
        self.path = f"{parent.path}>{label}" if parent is not None else label
        self.weight = 1.5 if tag in ("article", "main") else 1.2 if words & GOOD_WORDS else 1.0


def _running(text: str, links: int) -> int:
    return max(0, len(text) - 2 * links)


def _without_asides(blocks: list[tuple[str, Node, int]], mains: int) -> list[tuple[str, Node, int]]:
    """The blocks outside containers that class words, or elements such as forms, mark as asides. They do not where all of the article, or
    most of the page's text, is inside; within an article, a word beside others (``related-work``) does only where links prevail."""
    def comments(node: Node) -> bool:
        while node is not None:
            if node.mark == COMMENT and not 0 < node.mains == mains:
                return True
            node = node.parent
        return False

    remarks: dict[int, bool] = {}
    total = 0
    for text, node, links in blocks:
        if id(node) not in remarks:
            remarks[id(node)] = comments(node)
        if not remarks[id(node)]:
            value, at = _running(text, links), node
            total += value
            while at is not None:
                at.text += value
                at.chars += len(text)
                at = at.parent

    def marked(node: Node) -> bool:
        if node.mark == WRAPPER:
            return not 0 < node.mains == mains and (node.text < WRAPPED_TEXT or mains > 0 or 10 * node.text <= 9 * total)
        if node.mark == COMMENT:
            return not 0 < node.mains == mains
        if node.mark == STRONG:
            return node.mains < mains or 10 * node.text <= 9 * total
        if node.mark == WEAK and node.inside:
            return not node.mains and 2 * node.text < node.chars
        return node.mark == WEAK and not node.mains and 2 * node.text <= total

    kept = []
    for block in blocks:
        way, at = [], block[1]
        while at is not None and at.aside is None:
            way.append(at)
            at = at.parent
        for node in reversed(way):
            node.aside = (node.parent is not None and node.parent.aside) or marked(node)
        if not block[1].aside:
            kept.append(block)
    return kept


def parse(html: str) -> list[tuple[str, Node, int]]:
    """The blocks of text outside asides, in page order: text, container, characters in links."""
    tops = [Node("body", "", None)]
    stack, blocks, held, links, in_link, at = tops[:], [], [], 0, False, 0

    def flush() -> None:
        nonlocal held, links
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                blocks.append((text, stack[-1], links))
            held, links = [], 0

    while at < len(html):
        token = _TOKEN.search(html, at)
        text = html[at:token.start()] if token else html[at:]
        if text and not stack[-1].dropped:
            held.append(text)
            links += len(text.strip()) if in_link else 0
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        tag, closing = token[2].lower(), bool(token[1])
        if tag == "button" and any(not h.isspace() for h in held):
            held.append(" ")  # a word of a sentence
        elif tag in SKIPPED:
            if not closing and not token[3].endswith("/"):
                end = _ENDS[tag].search(html, at)
                at = end.end() if end else (len(html) if tag in ("script", "style", "textarea", "title") else at)
            held.append(" ")
        elif tag == "a":
            in_link = not closing
        elif tag == "br":
            held.append(" ")
        elif tag in BLOCKS:
            flush()
            if tag == "h1":
                stack[-1].head = True
            if tag in CONTAINERS and tag != "body":
                if not closing:
                    stack.append(Node(tag, token[3], stack[-1]))
                elif any(n.tag == tag for n in stack[1:]):
                    while stack.pop().tag != tag:
                        pass
            elif tag == "body" and not closing and token[3] and len(stack) == 1:
                stack[0] = Node("body", token[3], None)
                tops.append(stack[0])
    flush()
    return _without_asides(blocks, sum(n.mains for n in tops))


def _lifted(node: Node) -> Node:
    """The outermost article or main around a container, or the container itself."""
    best, at = node, node
    while at is not None:
        best = at if at.tag in ("article", "main") else best
        at = at.parent
    return best


def held_text(blocks: list[tuple[str, Node, int]]) -> tuple[dict[str, int], dict[str, Node], int]:
    """Running text per path with all that is below it, a container of each path, and the
    running text of the page."""
    own: dict[int, int] = {}
    nodes: dict[int, Node] = {}
    for text, node, links in blocks:
        own[id(node)] = own.get(id(node), 0) + _running(text, links)
        nodes[id(node)] = node
    held: dict[str, int] = {}
    first: dict[str, Node] = {}
    for key, value in own.items():
        at = nodes[key]
        while at is not None:
            held[at.path] = held.get(at.path, 0) + value
            first.setdefault(at.path, at)
            at = at.parent
    return held, first, sum(own.values())


def best_path(blocks: list[tuple[str, Node, int]]) -> tuple[str | None, float]:
    """The path of the page's best container and the running text it holds: the outermost
    article or main with most of the text, else the lowest container with nearly all of it,
    and one further out if that adds the heading."""
    held, first, total = held_text(blocks)
    if not total:
        return None, 0.0
    named = [p for p, n in first.items() if n.tag in ("article", "main") and held[p] > total / 2]
    if named:
        best = _lifted(first[max(named, key=lambda p: (held[p], p))]).path
        return best, float(held[best])
    lowest = max((p for p, n in first.items() if n.tag in SCORED and held[p] >= NEARLY_ALL * total), key=len, default=None)  # one within the other
    if lowest is None:  # text before and after the body tag
        lowest = max(held, key=lambda p: (held[p], p))
    headed: set[str] = set()
    for node in {id(n): n for _, n, _ in blocks if n.head}.values():
        while node is not None:
            headed.add(node.path)
            node = node.parent
    at = first[lowest]
    while at is not None and not (at.path in headed and at.tag in SCORED):
        at = at.parent
    best = lowest if at is None else at.path
    return best, float(held[best])


def text_at(blocks: list[tuple[str, Node, int]], path: str | None) -> str:
    """The blocks inside containers of the path, joined by line feeds."""
    found, inside = [], {}
    for text, node, _ in blocks:
        key = id(node)
        if key not in inside:
            at = node
            while at is not None and at.path != path:
                at = at.parent
            inside[key] = at is not None
        if inside[key]:
            found.append(text)
    return "\n".join(found)


def extract(html: str, winner: str | None) -> str:
    """The text at the host's winning path, or at the page's own best if most of the page's
    text is elsewhere. A winner that is named as an article may hold less, as other text of
    the page can be long, but no less than a tenth."""
    blocks = parse(html)
    if winner is not None:
        held, first, total = held_text(blocks)
        if winner in held:
            last = first[winner]
            if held[winner] >= total * (NAMED_SHARE if last.tag in ("article", "main") or last.weight > 1 else 0.5):
                return text_at(blocks, winner)
    best, _ = best_path(blocks)
    return text_at(blocks, best) if best is not None else "\n".join(text for text, _, _ in blocks)  # only links


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = [best_path(parse(h)) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64())],
                                         names=["host", "path", "score"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h, w) for h, w in zip(batch.column("html").to_pylist(), batch.column("winner").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_paths(rows: DataFrame) -> DataFrame:
    """``(host, winner)``: the path with most votes of a host's pages (``host``, ``html``); of
    equally many that with the larger score, then the later path."""
    votes = rows.where("host <> ''").mapInArrow(_vote, "host string, path string, score double").where("path IS NOT NULL")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    return counted.groupBy("host").agg(F.max(F.struct("votes", "score", "path"))["path"].alias("winner"))


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row: the main text of the whole page.

    Character references are decoded, white space inside a block becomes one space, and blocks
    are joined by a line feed; without any text it is empty. A null page is empty, a null url
    has the empty host. Null ids and repeated rows stay. An empty table gives an empty one.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    host, _ = url_parts(F.col("_url"))
    rows = rows.select("page_id", "url", "html", F.col("url").alias("_url")).select("page_id", "url", "html", host.alias("host"))
    winners = freeze(host_paths(rows.select("host", "html")))
    joined = rows.join(broadcast_if_small(winners, BROADCAST_HOSTS), "host", "left").select("page_id", "url", "html", "winner")
    kind = rows.schema["page_id"].dataType.simpleString()
    found = joined.mapInArrow(_extract, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
