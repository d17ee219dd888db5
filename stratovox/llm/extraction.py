"""Main-text extraction from HTML by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, fully to the parent and by a falling
share to those above; a container's points are discounted by the share of its text that stands in links.
The best container and those of its siblings that look like text are kept, in page order.

Blocks are the runs of text between block-level tags. Character references are decoded, white space inside
a block becomes one space, the ends are trimmed, and blocks are joined by one line feed. Nothing is cut
off and nothing else is dropped.

Defined cases: null, empty and tag-only pages give an empty text; unclosed, stray and wrongly nested tags
are repaired as browsers do for the common cases; repeated rows give equal results; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Tag names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math object canvas select button".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu head".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCK - frozenset("br caption td th tr tbody thead tfoot dd dt li body html head optgroup option legend summary".split())
#: An open tag of the key ends an open tag of the value, up to the nearest of the stops.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol menu dl table html body article section main div".split())
#: Words in a class, id or role that mark a container as not part of an article.
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed|s)?|promo(?:tion|ted|s)?|banner|cookies?(?:bar)?|consent|gdpr|notice|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|sign-?up|login|paywall|side-?bar|widget|rail|related|recommend(?:ed|ations)?|more-?stories|trending|popular|"
    r"share|sharing|social|comments?(?:list)?|respond|disqus|replies|discussion|nav(?:bar|igation)?|menu|breadcrumbs?|pagination|pager|tags?-?list|"
    r"footer|site-?header|masthead|top-?bar|skip(?:-?link)?|toolbar|search(?:box)?|copyright|legal|disclaimer|alert|contentinfo|complementary|search)(?=$|[\s_-])",
    re.I,
)
WANTED = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog|hentry)(?=$|[\s_-])", re.I)

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "items", "unwanted", "wanted", "score", "chars", "linked", "block", "article")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.items = tag, parent, []
        self.score, self.chars, self.linked = 0.0, 0, 0
        #: The nearest block that holds the node's text, and whether an article stands around it.
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.article = parent is not None and (parent.article or parent.tag in ("article", "main"))
        self.unwanted, self.wanted = tag in BOILERPLATE, tag in ("article", "main")
        if attributes and tag not in ("html", "body"):
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), next(filter(None, values), "")
                if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                    self.unwanted = True
                elif name in ("class", "id", "role") and value:
                    if UNWANTED.search(value) and tag not in ("article", "main"):
                        self.unwanted = True
                    elif WANTED.search(value):
                        self.wanted = True


class Scanner:
    """Tags of a page, in time linear in its length: what was sought in vain once isn't sought again."""

    def __init__(self, page: str):
        self.page, self.absent = page, set()

    def find(self, what: str, start: int) -> int:
        """Where ``what`` comes next, or -1."""
        if what in self.absent:
            return -1
        at = self.page.find(what, start)
        if at < 0:
            self.absent.add(what)
        return at

    def tag(self, start: int) -> tuple[int, int, str, str] | None:
        """(begin, end, name, attributes) of the next tag, whose name begins with / for end tags and is empty for comments and declarations."""
        page = self.page
        while (at := self.find("<", start)) >= 0:
            if page.startswith("<!--", at):
                end = self.find("-->", at)
                return at, end + 3 if end >= 0 else len(page), "", ""
            if page[at + 1 : at + 2] in ("!", "?"):
                end = self.find(">", at)
                return at, end + 1 if end >= 0 else len(page), "", ""
            name = _NAME.match(page, at + 1)
            if name:
                end = name.end()
                while (stop := _QUOTE_OR_END.search(page, end)) and stop[0] != ">":
                    close = self.find(stop[0], stop.end())
                    end = close + 1 if close >= 0 else stop.end()
                end = stop.end() if stop else len(page)
                return at, end, name[0].lower(), page[name.end() : end - 1 if stop else end]
            start = at + 1
        return None

    def end_tag(self, name: str, start: int) -> int | None:
        """Where the next end tag of this name ends."""
        if f"</{name}" in self.absent:
            return None
        found = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(self.page, start)
        if not found:
            self.absent.add(f"</{name}")
        return found.end() if found else None


class _Open:
    """The open nodes from the root down, and where the tags among them stand."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.by_tag: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.firm: list[int] = []  # blocks that an inline end tag can't close
        self.stops: list[int] = []

    def _lists(self, tag: str):
        yield self.by_tag.setdefault(tag, [])
        if tag in BLOCK:
            yield self.blocks
            if tag not in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
                yield self.firm
        if tag in STOPS:
            yield self.stops

    def push(self, node: Node) -> None:
        for found in self._lists(node.tag):
            found.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Close everything from this depth down."""
        while len(self.nodes) > depth:
            for found in self._lists(self.nodes.pop().tag):
                found.pop()

    def nearest(self, tag: str) -> int:
        return self.by_tag[tag][-1] if self.by_tag.get(tag) else -1


def parse(page: str) -> Node:
    """The page's tree: children are nodes and texts in page order. Scripts, styles, comments and the like are left out."""
    root = Node("html", None)
    opened, scanner = _Open(root), Scanner(page)
    at = 0
    while at < len(page):
        node = opened.nodes[-1]
        found = scanner.tag(at)
        if not found:
            node.items.append(page[at:])
            break
        start, end, tag, attributes = found
        if start > at:
            node.items.append(page[at:start])
        at = end
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            depth = opened.nearest(tag)
            if depth > 0:
                # a stray inline end tag doesn't close the blocks around it
                if tag in BLOCK or not opened.firm or opened.firm[-1] <= depth:
                    opened.close(depth)
            elif tag in BLOCK:
                node.items.append(Node("br", node))
            continue
        if tag in RAW and not attributes.endswith("/"):
            stop = scanner.end_tag(tag, at)
            at = stop if stop else (len(page) if tag in ("script", "style", "textarea", "title") else at)
            if tag in BLOCK:
                node.items.append(Node("br", node))
            continue
        if tag in CLOSES_PARAGRAPH and opened.blocks and opened.nodes[opened.blocks[-1]].tag == "p":
            opened.close(opened.blocks[-1])
        for ended in ENDED_BY.get(tag, ()):
            depth = opened.nearest(ended)
            if depth > (opened.stops[-1] if opened.stops else 0):
                opened.close(depth)
        if tag == "html":
            continue
        node = opened.nodes[-1]
        new = Node(tag, node, attributes)
        node.items.append(new)
        if tag not in VOID and not attributes.endswith("/"):
            opened.push(new)
    return root


def _is_site_header(node: Node) -> bool:
    """A header outside articles belongs to the site."""
    return node.tag == "header" and not node.article


def _blocks(node: Node, out: list[str], run: list[str]) -> None:
    """Blocks below a node in page order, without unwanted containers; ``run`` holds the open block's pieces."""

    def close() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        at, i = stack.pop()
        if i == 0 and at.tag in BLOCK:
            close()
        while i < len(at.items):
            item = at.items[i]
            i += 1
            if isinstance(item, str):
                run.append(item)
            elif item.unwanted or _is_site_header(item):
                close()
            else:
                stack.append((at, i))
                stack.append((item, 0))
                break
        else:
            if at.tag in BLOCK:
                close()
    close()


def _score(root: Node) -> list[Node]:
    """Give every container its points; the containers that have any."""
    order: list[tuple[Node, bool]] = []
    stack = [(root, False)]
    while stack:
        node, link = stack.pop()
        order.append((node, link))
        for item in node.items:
            if isinstance(item, Node) and not item.unwanted and not _is_site_header(item):
                stack.append((item, link or item.tag == "a"))
    own: dict[int, str] = {}
    for node, link in order:
        text = "".join(x for x in node.items if isinstance(x, str))
        text = _SPACE.sub(" ", text).strip()
        own[id(node)] = text
        node.chars, node.linked = len(text), len(text) if link else 0
    for node, _ in reversed(order):
        if node.parent is not None and node is not root:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    scored = []
    for node, link in order:
        # inline text counts for the block that it stands in
        text = own[id(node)]
        if not text or link:
            continue
        block = node.block
        points = 1 + text.count(",") + len(text) / 100
        up, share = block.parent if block.tag in ("p", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "blockquote", "br", "dd") and block.parent is not None else block, 1.0
        while up is not None and share > 0.05:
            if up.score == 0:
                scored.append(up)
            up.score += points * share
            up, share = up.parent, share * 0.4
    for node in scored:
        node.score *= 1 - node.linked / max(1, node.chars)
        if node.wanted:
            node.score *= 1.5 if node.tag not in ("article", "main") else 3
        elif node.tag in ("html", "body"):
            node.score *= 0.6
    return scored


def main_text(page: str | None) -> str:
    """The text of the best container and of those siblings that pass for text."""
    if not page:
        return ""
    root = parse(page)
    scored = _score(root)
    if not scored:
        return ""
    best = max(scored, key=lambda n: n.score)
    while best.parent is not None and best.parent.tag in ("article", "main") and best.tag not in ("article", "main"):
        best = best.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("html", "body"):
        kept = []
        for item in best.parent.items:
            if item is best:
                kept.append(item)
            elif isinstance(item, Node) and not item.unwanted and not _is_site_header(item):
                density = item.linked / max(1, item.chars)
                if item.score >= max(10, 0.2 * best.score) and density < 0.3 or item.tag == best.tag == "article" and item.chars and density < 0.3:
                    kept.append(item)
                elif item.tag in ("p", "pre", "blockquote") and item.chars > 80 and density < 0.25:
                    kept.append(item)
    out: list[str] = []
    for node in kept:
        _blocks(node, out, [])
    return "\n".join(out)


def extracted(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """All columns of ``pages`` but the html, and the main text, in one pass without a shuffle. ``name`` must not be a column yet."""
    place = pages.columns.index(html_col)
    fields = [f for f in pages.schema.fields if f.name != html_col]

    def scan(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                texts = pa.array([main_text(p) for p in part.column(place).to_pylist()], pa.string())
                columns = [c for k, c in enumerate(part.columns) if k != place]
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*(f.name for f in fields), name])

    return pages.mapInArrow(scan, T.StructType([*fields, T.StructField(name, T.StringType())]))
