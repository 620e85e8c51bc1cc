"""Main text of web pages by composite text density.

Every node of the page's tree gets a density: its characters per tag, lowered where many of them are in
links. A node's density sum is that of its children. On the path from the body to the densest node,
the least density is the threshold that the main content must reach. Within every node that reaches it, the
subtree with the largest density sum is kept, and what lies between kept subtrees as part of the same text.
What is known not to be content never counts.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.common import as_bytes, small_batches

#: Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "script style textarea noscript template iframe xmp noembed noframes head title nav footer aside button select option "
    "input label fieldset legend datalist menu dialog svg math canvas object embed audio video map".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
BLOCKS = frozenset(
    "#page #run address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav ol optgroup "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
) | (DROPPED - INLINE) | (RAW - INLINE)
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
ENDS_BEFORE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html div article section main td th blockquote".split())
#: Words in a class, id or role that mark what is not content.
CLUTTER = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|notification|popup|modal|overlay|"
    r"comment|comments|commentlist|disqus|respond|replies|reply|discussion|sidebar|side|rail|widget\w*|menu|nav|navbar|navigation|breadcrumb\w*|"
    r"header|masthead|topbar|footer|foot|copyright|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|login|search|"
    r"pagination|pager|skip|toolbar|complementary|contentinfo|form|alert|disclaimer)(?:$|[\s_-])",
    re.I,
)
#: Of these words, those that leave no doubt; the others may be what a part of an article is about.
CLEAR = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|popup|modal|overlay|comment|comments|commentlist|disqus|respond|"
    r"sidebar|widget\w*|menu|nav|navbar|navigation|breadcrumb\w*|masthead|newsletter|subscribe|signup|login|pagination|pager|toolbar|"
    r"notice|notification|alert|disclaimer|banner|footer|copyright)(?:$|[\s_-])",
    re.I,
)
#: Characters per tag below which a part of an article is no prose.
_PROSE = 25
#: Names that say what a page has or lacks ("no-sidebar", "has-side-nav"), not what the element is.
_STATE = re.compile(r"(?:^|\s)(?:no|not|has|have|with|without|hide|show)[_-]\S*", re.I)
#: Elements of a text, whose ids are the slugs of their headings.
SLUGGED = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p li dl dt dd blockquote pre figure figcaption table".split())
#: Share of the body's text outside links that makes a node too large to be left out for its name.
_LARGE = 2 / 3
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TEXTUAL = HEADINGS | frozenset("p ul ol dl blockquote pre table figure".split())
_KEPT = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|content)(?:$|[\s_-])", re.I)
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)"
    # A quote that never closes: the tag ends at the next bracket.
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANK = re.compile(r"\s+")


def is_inline(tag: str) -> bool:
    """Whether an element runs on within its line; unknown elements do."""
    return tag in INLINE or tag not in BLOCKS


class Node:
    """An element. What its place in the tree means is carried down, so that no question walks up to the root."""

    __slots__ = (
        "tag", "items", "parent", "dropped", "named", "clear", "attributes", "chars", "links", "tags", "link_tags", "density", "total",
        "article", "main", "in_body", "open_p", "item", "first", "last",
    )

    def __init__(self, tag: str, parent: Node | None, dropped: bool, named: str = "", attributes: str = ""):
        self.tag, self.parent, self.dropped, self.named, self.attributes = tag, parent, dropped, named, attributes
        self.items: list[Node | str] = []
        self.clear = False
        # The outermost article and main around or at the node, the paragraph that a block would end,
        # and the nearest element that matters to the end of list items and cells.
        self.article = parent.article if parent and parent.article else self if tag == "article" else None
        self.main = parent.main if parent and parent.main else self if tag == "main" else None
        self.in_body = parent is not None and (parent.in_body or parent.tag == "body")
        self.open_p = self if tag == "p" else parent.open_p if parent and is_inline(tag) else None
        self.item = self if tag in SCOPE or tag in ENDS_BEFORE else parent.item if parent else None


def _hidden(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return "hidden" in attributes and any(m[1].lower() == "hidden" for m in _ATTRIBUTE.finditer(attributes))
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """The attribute that names an element as clutter, the tag of a form, or nothing; whether it leaves no doubt."""
    if tag == "form":
        return tag, True
    by, clear = "", False
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if tag not in ("body", "html") else ():
        name, value = name.lower(), a or b or c
        if name not in ("class", "id", "role") or name == "id" and tag in SLUGGED:
            continue
        if CLUTTER.search(value if name == "role" else _STATE.sub(" ", value)) and not (name != "role" and _KEPT.search(value)):
            by = name if by in ("", "id") else by
            clear = clear or bool(CLEAR.search(value if name == "role" else _STATE.sub(" ", value)))
    return by, clear


def parse(page: str) -> Node:
    """The tree of a page; end tags that nothing opened are left out, open elements end with their parent."""
    root = node = Node("#page", None, False)
    opened: dict[str, int] = {}
    seen: set[tuple[Node, str]] = set()
    at = 0

    def close(upto: Node) -> Node:
        """Ends all elements from the current one to ``upto``; gives what is around it."""
        up = node
        while True:
            opened[up.tag] -= 1
            if up is upto:
                return up.parent
            up = up.parent

    while True:
        found = _TAG.search(page, at)
        if not found:
            if at < len(page):
                node.items.append(page[at:])
            return root
        if found.start() > at:
            node.items.append(page[at : found.start()])
        at = found.end()
        ends_it, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
        if not tag:
            if found[0].startswith("<![CDATA["):
                node.items.append(html.escape(found[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if ends_it:
            if opened.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = close(up)
            continue
        if tag in CLOSES_P and node.open_p:
            node = close(node.open_p)
        if ends := ENDS_BEFORE.get(tag):
            up = node.item
            while up and up.tag not in ends and up.tag not in SCOPE:
                up = up.parent.item
            if up and up.tag in ends:
                node = close(up)
                if tag == "tr" and node.tag == "tr":
                    node = close(node)
        if tag in ("html", "body"):
            if (node, tag) in seen:
                continue
            seen.add((node, tag))
        named, clear = _named(tag, attributes)
        if tag == "header" and not (node.article or node.main):
            named, clear = tag, True
        new = Node(tag, node, _hidden(tag, attributes), named, attributes)
        new.clear = clear
        node.items.append(new)
        if tag in VOID or attributes.endswith("/") and tag in ("path", "rect", "circle", "use"):
            continue
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            closing = page.find(">", end.start()) if end else -1
            at = closing + 1 if closing >= 0 else len(page)
            continue
        opened[tag] = opened.get(tag, 0) + 1
        node = new


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*(?:>|/|$)", re.I)


def _order(root: Node) -> list[Node]:
    """Nodes that may hold content, parents first; each knows the places of its subtree in this order."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        node.first = len(found)
        found.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.dropped]
    for node in reversed(found):
        inner = [x.last for x in node.items if isinstance(x, Node) and not x.dropped]
        node.last = inner[-1] if inner else node.first + 1
    return found


def _measure(order: list[Node]) -> None:
    """Characters of each node, all and in links."""
    for node in reversed(order):
        children = [x for x in node.items if isinstance(x, Node) and not x.dropped]
        node.chars = sum(len(_BLANK.sub(" ", x).strip()) for x in node.items if isinstance(x, str)) + sum(x.chars for x in children)
        node.links = node.chars if node.tag == "a" else sum(x.links for x in children)


def drop_named(root: Node) -> None:
    """Drops what its name marks as clutter, but nothing that holds the content.

    A node stays, whatever its name, if it holds a <main>, articles of at least half the text of the
    page's largest one, or most of the body's text outside links where no article lies beside it. A
    section that only its id names stays within an article, and where no article lies beside it. Within an
    article a word that may be its subject drops nothing but forms, lists of links and what is no prose.
    """
    order = _order(root)
    marked = [n for n in order if n.named and n.tag not in ("article", "main")]
    if not marked:
        return
    _measure(order)
    body = next((n for n in order if n.tag == "body"), root)
    plain = body.chars - body.links
    above: dict[Node, tuple[int, bool]] = {}
    for node in order:
        parent = node.parent
        seen, inside = above[parent] if parent else (0, False)
        above[node] = seen + (parent is not None and parent.tag in ("article", "main")), inside or parent is not None and parent.tag == "article"
    # Within each node: articles and mains of any kind, mains, articles that are no comments, and their text.
    held: dict[Node, list[int]] = {}
    for node in reversed(order):
        mine = [sum(x) for x in zip([0] * 4, *(held[c] for c in node.items if isinstance(c, Node) and not c.dropped), strict=True)]
        held[node] = mine
        if node.tag == "main":
            mine[0], mine[1] = mine[0] + 1, mine[1] + 1
        elif node.tag == "article" and not node.named and not above[node][1]:
            mine[0], mine[2], mine[3] = mine[0] + 1, mine[2] + 1, node.chars - node.links
    # Elements below each node, and whether it is or holds a form.
    inner = {n: n.last - n.first - 1 for n in order}
    forms: dict[Node, bool] = {}
    for node in reversed(order):
        forms[node] = node.tag == "form" or any(
            x.tag in ("input", "select", "button", "textarea") if x.dropped else forms[x] for x in node.items if isinstance(x, Node)
        )
    largest = max((held[n][3] for n in order if n.tag == "article"), default=0)
    for node in marked:
        count, mains, articles, text = held[node]
        beside = held[root][0] - count - above[node][0]
        if mains or articles and 2 * text >= largest:
            continue
        if beside <= 0 and node.chars - node.links >= _LARGE * max(plain, 1):
            continue
        if above[node][1] and not node.clear and node.links * 2 < node.chars and not forms[node]:
            if node.tag in TEXTUAL or node.chars >= _PROSE * (1 + inner[node]):
                continue
        node.dropped = not (node.named == "id" and node.tag == "section" and (beside <= 0 or above[node][1]))


def main_nodes(root: Node) -> list[Node]:
    """The subtrees with the main content, in page order.

    A subtree in an article stands for the whole article. Where the densest one is in an article, what is
    neither in articles nor in its <main> is left out; in a <main> without articles, it is the <main>.
    """
    drop_named(root)
    order = _order(root)
    _measure(order)
    for node in reversed(order):
        children = [x for x in node.items if isinstance(x, Node) and not x.dropped]
        node.tags = len(children) + sum(x.tags for x in children)
        node.link_tags = sum(x.link_tags + (x.tag == "a") for x in children)
        node.total = 0.0
    bodies = [n for n in order if n.tag == "body"]
    body = bodies[0] if bodies else root
    share = body.links / max(body.chars, 1)
    for node in order:
        # Characters per tag, with a logarithm whose base grows with the share of link text.
        chars, links, tags = node.chars, node.links, max(node.tags, 1)
        plain = max(chars - links, 1)
        base = math.log(chars / plain * links + share * chars + math.e)
        ratio = chars / max(links, 1) * tags / max(node.link_tags, 1)
        node.density = chars / tags * math.log(max(ratio, 1.0)) / math.log(max(base, math.e)) if chars else 0.0
        if chars and not links:
            node.density = chars / tags
    for node in order[1:]:
        node.parent.total += node.density
    inside = [n for n in order if n is body or n.in_body or body is root]
    best = max(inside, key=lambda n: n.total)
    path, up = [], best
    while up is not None and up is not body:
        path.append(up.density)
        up = up.parent
    least = min([*path, body.density], default=0.0)
    kept: set[Node] = set()
    peak: dict[Node, Node] = {}
    for node in reversed(order):
        peak[node] = max([node, *(peak[x] for x in node.items if isinstance(x, Node) and not x.dropped)], key=lambda n: n.total)
    todo = [body]
    while todo:
        node = todo.pop()
        if node.density < least or not node.chars or node in kept:
            continue
        kept.add(peak[node])
        if peak[node] is not node:
            todo += [x for x in node.items if isinstance(x, Node) and not x.dropped]
    # A block that is cut into sections has its sections as children: the article around them is whole.
    article, main = best.article, best.main
    articles = [n for n in inside if n.article is n]
    places = [n.first for n in articles]
    spread = [n for n in articles if not n.named and n.chars and 3 * n.links <= n.chars]
    fit = set(spread)
    if article:
        whole = [article]
        for node in kept:
            if node.article:
                whole.append(node.article)
            elif bisect_left(places, node.first) < bisect_left(places, node.last):
                whole += [x for x in articles[bisect_left(places, node.first) : bisect_left(places, node.last)] if x in fit]
            elif main and node.main is main:
                whole.append(_block(node, body))
        whole = [n for n in whole if n is article or not n.named]
    elif main:
        return [main]
    elif best is body and (mains := [n for n in inside if n.tag == "main"]):
        return [max(mains, key=lambda n: n.chars)]
    elif best is body and 2 * sum(n.chars - n.links for n in spread) >= body.chars - body.links:
        whole = spread or [body]
    else:
        while is_inline(best.tag) or best.tag in ("p", "li", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "td", "tr", "tbody", "table", "ul", "ol"):
            if best is body or best.parent is None:
                break
            best = best.parent
        whole = [best, *(_block(n, body) for n in kept)]
    chosen = set(whole)
    chosen = _outer(chosen)
    return _joined(chosen, body, article is not None)


def _outer(chosen: set[Node]) -> set[Node]:
    """The chosen nodes that lie in no other one."""
    found: set[Node] = set()
    end = -1
    for node in sorted(chosen, key=lambda n: n.first):
        if node.first >= end:
            found.add(node)
            end = node.last
    return found


def _block(node: Node, body: Node) -> Node:
    """The block around inline elements and parts of a list or table."""
    up = node
    while is_inline(up.tag) or up.tag in ("li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot"):
        if up.parent is None or up.parent is body:
            return node if is_inline(up.tag) else up
        up = up.parent
    return up


def _alike(node: Node) -> tuple[str, str] | None:
    """What repeated parts of a text have in common: their tag and class; none for a bare <div>."""
    kind = next((a or b or c for name, a, b, c in _ATTRIBUTE.findall(node.attributes) if name.lower() == "class"), "")
    return (node.tag, kind) if kind or node.tag in ("section", "article") else None


def _joined(chosen: set[Node], body: Node, articles: bool) -> list[Node]:
    """The chosen subtrees in page order, with the headings, texts and like parts beside them, unless those are links."""
    if not chosen or body in chosen:
        return list(chosen)
    paths: dict[Node, int] = {}
    for node in chosen:
        up = node.parent
        while up is not None:
            paths[up] = paths.get(up, 0) + 1
            up = up.parent
    top = next(iter(chosen)).parent
    while top is not None and paths[top] < len(chosen):
        top = top.parent
    out: list[Node] = []
    todo: list[Node] = [top]
    while todo:
        node = todo.pop()
        if node not in paths:
            out.append(node)
            continue
        items = _runs(node, lambda x: x in chosen or x in paths)
        places = [i for i, x in enumerate(items) if x in chosen or x in paths]
        alike = {_alike(x) for x in items if x in chosen} - {None}
        more = []
        for i, x in enumerate(items):
            if i in places:
                more.append(x)
            elif not x.chars or 2 * x.links > x.chars or x.named and x.tag == "article":
                continue
            elif x.tag in HEADINGS and i < places[-1]:
                if not (articles and (node is body or len(chosen) == 1)):
                    more.append(x)
            elif _alike(x) in alike:
                more.append(x)
            elif not articles and (x.tag in TEXTUAL or x.tag == "#run") and (node is not body or places[0] < i < places[-1]):
                more.append(x)
        todo += reversed(more)
    return out


def _runs(node: Node, alone: Callable[[Node], bool]) -> list[Node]:
    """The blocks of a node and what stands alone; text and inline elements between them as one node each."""
    found: list[Node] = []
    for x in node.items:
        if isinstance(x, Node) and (x.dropped or not is_inline(x.tag) or alone(x)):
            if not x.dropped:
                found.append(x)
            elif not is_inline(x.tag):
                found.append(_run())
            continue
        if not found or found[-1].tag != "#run":
            found.append(_run())
        run = found[-1]
        run.items.append(x)
        run.chars += len(_BLANK.sub(" ", x).strip()) if isinstance(x, str) else x.chars
        run.links += 0 if isinstance(x, str) else x.links
    return found


def _run() -> Node:
    run = Node("#run", None, False)
    run.chars = run.links = 0
    return run


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node`` in page order, white space made one blank and trimmed."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _BLANK.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            line.append(x)
        elif x.dropped:
            if not is_inline(x.tag):
                end()
        elif is_inline(x.tag):
            todo += reversed(x.items)
        else:
            end()
            todo.append(None)
            todo += reversed(x.items)
    end()
    return out


def main_text(page: str | None) -> str:
    """Main text of a page; empty if it has none."""
    return " ".join(x for node in main_nodes(parse(page)) for x in blocks(node)) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    A null or empty page has an empty text; broken markup is read as far as it goes. An empty table
    gives an empty table.
    """

    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return pa.array([main_text((t or b"").decode("utf-8", "replace")) for t in as_bytes(column)], pa.string())

    small_batches(pages.sparkSession)
    out = pages.select("page_id", "url", text("html").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
