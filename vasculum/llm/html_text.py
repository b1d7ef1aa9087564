"""Main text of web pages by scoring the page's tree.

Paragraphs earn points for their length and commas, pass them to their parent and, halved, to their grandparent, and a
container's points are discounted by the share of its text that lies in links. The best container is kept, with those
siblings that hold article text too. Every pass over a page takes time linear in its length, malformed or not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vasculum.llm.storage import in_parts

PART_CHARS = 8_000_000
#: HTML element classes (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements and names of classes, ids and roles that are not article text.
DROPPED = RAW | frozenset("head nav header footer aside form button select option input dialog menu canvas audio video object".split())
#: A form, or an element dropped by its name unless the name is one of these, is article text after all if it holds more than half of the
#: page's text outside links, and so many characters. Quotations are never dropped by a name.
NEVER = re.compile(r"comment|disqus|repl(?:y|ies)|cookie|consent|gdpr|hidden|(?:^|[\s_-])(?:nav|navbar|navigation|menu|footer)(?:[\s_-]|$)", re.IGNORECASE)
MOST, LEAST_MAIN = 0.5, 200
QUOTED = frozenset("blockquote pre".split())
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|consent|contentinfo|cookies?|disqus|footer|gdpr|hidden|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notice|pager|pagination|popup|promo|promoted|related|replies|reply|search|share|sharing|sidebar|skip|"
    r"social|sponsor|sponsored|subscribe|toolbar|widget|complementary)(?:[\s_-]|$)",
    re.IGNORECASE,
)
#: Siblings of the article with these elements are text whatever their length; others from so many characters. At most this share may be in links.
PROSE = frozenset("p pre blockquote ul ol dl table figure".split())
LONG, MOST_LINKED = 80, 0.3
BOUNDS = BLOCKS | {"option", "select"}
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot caption html body".split())
ENDS_SELF = {"li": "ul ol menu dir", "dt": "dl", "dd": "dl", "tr": "table", "td": "table tr", "th": "table tr", "option": "select"}
NAME_END, SPECIAL = re.compile(r"[\s/>]"), re.compile("[>\"']")
NAMES = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)


class _Node:
    __slots__ = ("block", "children", "dropped", "doubtful", "parent", "points", "size", "tag")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool = False, doubtful: bool = False):
        self.tag, self.parent, self.dropped, self.doubtful = tag, parent, dropped, doubtful
        self.children: list[_Node | str] = []
        self.points, self.size = 0.0, 0
        #: The nearest element, this one included, at which an omitted end tag may be supplied.
        self.block = self if parent is None or tag in BOUNDS else parent.block


def _unlikely(tag: str, attributes: str) -> tuple[bool, bool]:
    """If an element is dropped, and if that is in doubt: it may hold the article."""
    if tag in DROPPED and tag != "form":
        return True, False
    doubtful = tag == "form"
    if not attributes or tag in ("html", "body"):
        return doubtful, doubtful
    dropped = doubtful
    for name, value in NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True, False
        if name in ("class", "id", "role") and tag not in ("article", "main") and tag not in QUOTED and UNLIKELY.search(value):
            if NEVER.search(value):
                return True, False
            dropped = doubtful = True
        if name in ("class", "id") and tag == "article" and re.search(r"comment|reply", value, re.IGNORECASE):
            return True, False
    return dropped, doubtful


class _Tags:
    """Tags of a page, found with one forward cursor: what was searched once is remembered, so broken tags cost no second pass."""

    def __init__(self, html: str):
        self.html = html
        self.seen: dict[re.Pattern, tuple[int, int]] = {}  # from where searched, where found
        self.last: dict[str, int] = {}  # characters, and from where on there is no other
        self.dead: set[int] = set()  # quotation marks from which no tag's end is reached

    def _next(self, pattern: re.Pattern, at: int) -> int:
        begin, found = self.seen.get(pattern, (0, -1))
        if not begin <= at <= found:
            match = pattern.search(self.html, at)
            found = match.start() if match else len(self.html)
            self.seen[pattern] = (at, found)
        return found

    def _find(self, mark: str, at: int) -> int:
        found = -1 if at >= self.last.get(mark, len(self.html)) else self.html.find(mark, at)
        if found < 0:
            self.last[mark] = min(at, self.last.get(mark, at))
        return found

    def _end(self, at: int) -> int:
        """The > that ends a tag's attributes; -1 if there is none outside quotation marks."""
        passed = []
        while (at := self._next(SPECIAL, at)) < len(self.html):
            mark = self.html[at]
            if mark == ">":
                return at
            close = -1 if at in self.dead else self._find(mark, at + 1)
            passed.append(at)
            if close < 0:
                break
            at = close + 1
        self.dead.update(passed)
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """Start, end, lower-case name (empty for comments and declarations), whether an end tag, attributes."""
        html, at = self.html, 0
        while (at := html.find("<", at)) >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                found = (at, end + 3 if end >= 0 else len(html), "", False, "")
            elif html.startswith(("<!", "<?"), at):
                end = self._find(">", at)
                found = (at, end + 1, "", False, "") if end >= 0 else None
            else:
                begin = at + 1 + html.startswith("/", at + 1)
                found = None
                if html[begin : begin + 1].isascii() and html[begin : begin + 1].isalpha():
                    stop = self._next(NAME_END, begin)
                    end = self._end(stop)
                    if end >= 0:
                        found = (at, end + 1, html[begin:stop].lower(), begin == at + 2, html[stop:end])
            if found is None:
                at += 1
                continue
            jump = yield found
            at = max(found[1], jump or 0)
            if jump is not None:
                yield found  # the answer to send


def _tree(html: str) -> _Node:
    """The page's elements, with omitted end tags supplied; unmatched end tags are ignored. Takes time linear in the page's length."""
    root = node = _Node("", None)
    opened: dict[str, int] = {}
    tags = iter(_Tags(html))
    text = 0

    def close(last: _Node) -> _Node:
        nonlocal node
        while True:
            done, node = node, node.parent
            opened[done.tag] -= 1
            if done is last:
                return node

    while (found := next(tags, None)) is not None:
        start, at, name, ends, attributes = found
        if start > text:
            node.children.append(html[text:start])
        text = at
        if not name:
            continue
        if ends:
            if opened.get(name):
                up = node
                while up.tag != name:
                    up = up.parent
                close(up)
            continue
        if name in CLOSES_P or name in ENDS_SELF:
            stops = ENDS_SELF.get(name, "").split()
            closes = () if name not in ENDS_SELF else ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            up = node.block
            while up is not root and (up.tag not in BLOCKS or up.tag in closes or up.tag == "p"):
                parent = up.parent
                if up.tag == "p" and name in CLOSES_P or up.tag in closes:
                    close(up)
                if parent.tag in stops:
                    break
                up = parent.block
        child = _Node(name, node, *_unlikely(name, attributes))
        node.children.append(child)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(html, at)
            text = end.end() if end else len(html)
            tags.send(text)
        elif name not in VOID and not (attributes.endswith("/") and name not in BLOCKS):
            node = child
            opened[name] = opened.get(name, 0) + 1
    if text < len(html):
        node.children.append(html[text:])
    return root


def _restore(root: _Node) -> None:
    """Take back in what was dropped in doubt but holds most of the page's text outside links."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        stack.extend((c, linked) for c in node.children if isinstance(c, _Node) and (not c.dropped or c.doubtful))
    if not any(node.doubtful for node, _ in order):
        return
    sizes: dict[int, int] = {}
    for node, linked in reversed(order):
        sizes[id(node)] = sum(sizes.get(id(c), 0) if isinstance(c, _Node) else 0 if linked else len(" ".join(c.split())) for c in node.children)
    for node, _ in order:
        if node.doubtful and sizes[id(node)] >= LEAST_MAIN and sizes[id(node)] > MOST * sizes[id(root)]:
            node.dropped = False


def _score(root: _Node) -> _Node:
    """The best container. Nodes that are dropped, and what is in them, neither give nor get points."""
    best, most = root, 0.0
    order: list[_Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, _Node) and not c.dropped)
    text: dict[int, int] = {}
    links: dict[int, int] = {}
    own: dict[int, tuple[int, int]] = {}
    for node in reversed(order):  # children first
        size = link = direct = commas = 0
        for c in node.children:
            if isinstance(c, str):
                words = " ".join(c.split())
                size, direct, commas = size + len(words), direct + len(words), commas + words.count(",")
            elif not c.dropped:
                size, link = size + text[id(c)], link + links[id(c)]
                if c.tag not in BLOCKS:
                    direct, commas = direct + own[id(c)][0], commas + own[id(c)][1]
        node.size = text[id(node)] = size
        links[id(node)] = size if node.tag == "a" else link
        own[id(node)] = (direct, commas)
    for node in order:
        if node.tag in BLOCKS and own[id(node)][0] and node.parent is not None:
            size, commas = own[id(node)]
            points = (1 + commas + min(size / 100, 3)) * (1 - links[id(node)] / max(text[id(node)], 1))
            points *= 1.0 if node.tag in ("p", "pre", "blockquote", "td") else 0.3
            node.parent.points += points
            if node.parent.parent is not None:
                node.parent.parent.points += points / 2
    for node in order:
        bonus = 25 if node.tag in ("article", "main") and text[id(node)] else 0
        points = (node.points + bonus) * (1 - links[id(node)] / max(text[id(node)], 1))
        node.points = points
        if points > most:
            best, most = node, points
    return best


def _blocks(nodes: list[_Node]) -> list[str]:
    """Texts of the blocks in page order: character references decoded, white space single, empty blocks left out."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if words := " ".join(unescape("".join(buffer)).split()):
            out.append(words)
        buffer.clear()

    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            buffer.append(item)
        elif item.tag == "br":
            buffer.append(" ")
        elif not item.dropped:
            if item.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()
    return out


def _text_and_links(nodes: list[_Node | str]) -> tuple[int, int, bool]:
    """Characters of the nodes' text, those in links, and whether some stand in a paragraph, list or the like. Dropped nodes have none."""
    size = link = 0
    prose = False
    stack = [(n, False, False) for n in nodes]
    while stack:
        node, linked, inside = stack.pop()
        if isinstance(node, str):
            n = len(" ".join(node.split()))
            size, link, prose = size + n, link + n * linked, prose or (inside and n > 0)
        elif not node.dropped:
            linked, inside = linked or node.tag == "a", inside or node.tag in PROSE
            stack.extend((c, linked, inside) for c in node.children)
    return size, link, prose


def _with_siblings(best: _Node) -> list[_Node | str]:
    """The container and those siblings that hold article text too, in page order.

    A sibling stays for its points, or if little of its text is in links and it is a paragraph, list or the like, holds one, or is long; text
    and inline elements between blocks are a paragraph. A heading stays if something of its section, up to the next heading of its level
    or above, does; if most of it is a link, only as an h1.
    """
    groups: list[list[_Node | str]] = []  # a block, or what stands between two
    for c in best.parent.children:
        block = isinstance(c, _Node) and (c is best or c.tag in BLOCKS)
        if block or not groups or isinstance(groups[-1][0], _Node) and (groups[-1][0] is best or groups[-1][0].tag in BLOCKS):
            groups.append([])
        groups[-1].append(c)
    need = 0.2 * best.points
    level, keep = [], []
    for own in groups:
        head = own[0] if isinstance(own[0], _Node) else None
        level.append(int(head.tag[1]) if head and head is not best and re.fullmatch("h[1-6]", head.tag) else 0)
        size, link, prose = _text_and_links(own)
        if level[-1]:
            keep.append(bool(size) and (link <= 0.5 * size or level[-1] == 1))
            continue
        prose = prose or head is None or head.tag not in BLOCKS
        scored = head is not None and not head.dropped and head.points >= need
        keep.append(head is best or bool(size) and (scored or (link <= MOST_LINKED * size and (prose or size >= LONG))))
    for k in range(len(groups) - 1, -1, -1):
        if level[k] and keep[k]:
            end = next((j for j in range(k + 1, len(groups)) if 0 < level[j] <= level[k]), len(groups))
            keep[k] = any(keep[j] and not level[j] for j in range(k + 1, end))
    return [c for own, stays in zip(groups, keep, strict=True) if stays for c in own]


def main_text(html: str | None) -> str:
    """Main text of a page; empty if it has none. Malformed pages are read as far as they go."""
    if not html:
        return ""
    root = _tree(html)
    _restore(root)
    best = _score(root)
    while best.parent is not None and best.parent.size == best.size:
        best = best.parent  # a mere wrapper: the siblings stand beside it
    return "\n".join(_blocks(_with_siblings(best) if best.parent is not None else [best]))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of `pages`.

    Null and empty pages give an empty text; ids and urls may be null or repeated; other columns are ignored; no rows give no rows.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_parts(batch, 2, PART_CHARS):
                texts = [main_text(h) for h in rows.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
