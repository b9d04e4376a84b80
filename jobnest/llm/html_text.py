"""Main text of HTML pages by tree scoring.

Every paragraph passes points for its length and its commas to its ancestors, discounted by link density; the container
with the best score wins, and its siblings stay if their own score is close or they are prose, with few links, whatever
their element; so does bare text between them.  Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are cut before scoring, by tag, role, class and id.  A form
and what only a class, id or role marks stay if they hold the page's main part, its longest article or most of its
paragraph points (reader comments by their whole name go however long they are).

A null or empty page, and one without any text, gives an empty text.  Broken markup (unclosed tags, cut pages) is read
as far as it goes.  Repeated rows are read one by one; an empty table gives no rows.  Of equal scores the first container
in page order wins.  Very long and deeply nested pages are read whole, in time about linear in their length.  Other columns
take no part, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame

from .common import map_batches, pick

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that never hold main text.
CUT = RAW | frozenset("nav footer aside button select option input head svg canvas object audio video dialog menu".split())
#: Words of class, id and role that mark what is not main text.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related respond replies reply search share sharing sidebar signup social sponsor sponsored subscribe widget "
    "contentinfo complementary navigation alert alerts disclaimer toolbar".split()
)
#: Of these the names of what readers wrote.
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
#: Words that say what an element has beside it, not what it is.
BESIDE = frozenset("has with without no not non".split())
#: Openings that close an open paragraph of the same kind first.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article section div main aside nav".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_VALUE = re.compile(r"""=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)aria-hidden\s*=\s*["']?\s*true\b|(?:^|\s)style\s*=\s*(?:"[^"]*display\s*:\s*none|'[^']*display\s*:\s*none|display:none)""", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Marks of an element: none, cut for good, hidden, a form or a class or id that may hold the main text, readers' comments.
KEEP, GONE, HIDDEN, DOUBT, READERS = range(5)

POINTS_EVERY, MOST_LENGTH_POINTS, SIBLING_SHARE, MOST_LINKS = 100, 3, 0.2, 0.25
#: Levels that a paragraph's points go up; above them its share would be under a hundredth.
REACH = 50


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "mark", "score", "chars", "link_chars", "inside")

    def __init__(self, tag, parent, mark):
        self.tag, self.parent, self.cut, self.mark = tag, parent, mark == GONE, mark
        #: It is an article or the main part, or in one.
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.children: list = []  # nodes and strings
        self.score = 0.0
        self.chars = self.link_chars = 0


def parse(html: str) -> Node:
    """A forgiving tree of the page; text is not decoded yet."""
    root = node = Node("#root", None, KEEP)
    opened: Counter[str] = Counter()
    at = 0
    while at < len(html):
        m = _TAG.search(html, at)
        if not m:
            node.children.append(html[at:])
            break
        if m.start() > at:
            node.children.append(html[at:m.start()])
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if m[0].startswith("<![CDATA["):
                node.children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if closing:
            up = node if opened[tag] else root
            while up.parent and up.tag != tag:
                # an inline end tag does not close blocks, and no end tag leaves its list or table
                up = up.parent if not (tag in INLINE and up.tag not in INLINE) else root
            if up.parent:
                node = _left(node, up.parent, opened)
            continue
        if tag not in INLINE and any(opened[t] for t in CLOSES.get(tag, ())) or tag not in INLINE and opened["p"]:
            node = _left(node, _closed(node, tag), opened)
        new = Node(tag, node, _mark(tag, attrs, node))
        node.children.append(new)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = html.find(">", end.end()) + 1 or len(html) if end else len(html)
        elif tag not in VOID and not attrs.endswith("/"):
            node = new
            opened[tag] += 1
    return root


def _left(node: Node, to: Node, opened: Counter) -> Node:
    """``to``, after all from ``node`` up to it are no longer open."""
    while node is not to:
        opened[node.tag] -= 1
        node = node.parent
    return to


def _closed(node: Node, tag: str) -> Node:
    """Where a block opens: it ends an open paragraph, heading or list item of its kind."""
    ends = CLOSES.get(tag, set()) | {"p"}
    up = node
    while up.parent and up.tag not in SCOPES:
        if up.tag in ends:
            return _closed(up.parent, tag)
        up = up.parent
    return node


def _mark(tag: str, attrs: str, parent: Node) -> int:
    if tag in CUT:
        return GONE
    if tag == "header":
        return KEEP if parent.inside else GONE
    if tag == "form":
        return DOUBT
    if tag in ("html", "body", "main") or not attrs:
        return KEEP
    if tag != "article" and (_BARE_HIDDEN.search(_VALUE.sub("=", attrs)) or _HIDDEN.search(attrs)):
        return HIDDEN
    mark = KEEP
    for m in _ATTR.finditer(attrs):
        for name in m[2].lower().strip("\"'").split():
            words = _WORDS.findall(name)
            if not words or BESIDE & set(words):
                continue
            # the page's title is an advert only by its whole name
            if tag == "h1" and not set(words) <= BOILERPLATE - {"header", "banner", "masthead"}:
                continue
            # the whole name, or a marker that leads or trails it
            if words[0] in BOILERPLATE or words[-1] in BOILERPLATE:
                if {words[0], words[-1]} & BOILERPLATE == {"header"} and parent.inside:
                    continue
                mark = max(mark, READERS if len(words) == 1 and words[0] in COMMENTS else DOUBT)
    return mark


def prune(root: Node) -> None:
    """Cuts the marked elements that do not hold the main text."""
    nodes: list[Node] = []
    _measure(root, False, nodes)
    if not any(n.mark for n in nodes):
        return
    total: dict[int, float] = {id(n): _points(n) for n in nodes}
    for n in reversed(nodes):
        if n.parent:
            total[id(n.parent)] += total[id(n)]
    holds: set[int] = set()
    longest = max((n for n in nodes if n.tag == "article" and not n.mark), key=lambda n: total[id(n)], default=None)
    for up in [longest, *(n for n in nodes if n.tag == "main")]:
        while up:
            holds.add(id(up))
            up = up.parent
    for n in nodes:
        # an article of readers' comments goes beside an article that is none
        if n.mark and id(n) not in holds and (n.tag != "article" or n.mark == READERS and longest):
            n.cut = n.mark != DOUBT or 2 * total[id(n)] <= total[id(root)]


def _measure(node: Node, link: bool, depth_first: list) -> None:
    """Characters and link characters of every node kept, without recursion."""
    order, stack = [], [(node, link)]
    while stack:
        n, inside = stack.pop()
        order.append((n, inside))
        stack += [(c, inside or c.tag == "a") for c in n.children if isinstance(c, Node) and not c.cut]
    for n, inside in reversed(order):
        own = sum(len(c.strip()) for c in n.children if isinstance(c, str))
        kids = [c for c in n.children if isinstance(c, Node) and not c.cut]
        n.chars = own + sum(c.chars for c in kids)
        n.link_chars = n.chars if inside else sum(c.link_chars for c in kids)
    depth_first += [n for n, _ in order]


def _points(n: Node) -> float:
    """Of a paragraph's own text; 0 for what is none."""
    if n.tag in INLINE or not n.parent:
        return 0
    text = "".join(_inline(n))
    length = len(text.strip())
    if not length:
        return 0
    return (1 + text.count(",") + min(length // POINTS_EVERY, MOST_LENGTH_POINTS)) * (1 - n.link_chars / max(1, n.chars))


def score(root: Node) -> list[Node]:
    """Points of paragraphs, passed to the parent whole, to the next one by half and on by less, ``REACH`` levels up."""
    nodes: list[Node] = []
    _measure(root, False, nodes)
    for n in nodes:
        points = _points(n)
        if not points:
            continue
        up, share = n.parent, 1
        while up and share < 2 * REACH:
            up.score += points / share
            up, share = up.parent, 2 if share == 1 else share + 2
    return nodes


def _inline(node: Node) -> list[str]:
    """The strings of a block itself and of the inline elements in it."""
    out, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif not c.cut and c.tag in INLINE:
            stack += reversed(c.children)
    return out


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below ``nodes`` in page order: decoded, white space as one space, trimmed, none empty."""
    out: list[str] = []
    text: list[str] = []

    def flush():
        if text:
            words = unescape("".join(text)).split()
            if words:
                out.append(" ".join(words))
            text.clear()

    stack: list = list(reversed(nodes))
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            text.append(c)
        elif not c.cut:
            if c.tag in INLINE:
                if c.tag in ("br", "wbr"):
                    text.append(" " if c.tag == "br" else "")
                stack += reversed(c.children)
            else:
                flush()
                stack += [None, *reversed(c.children)]
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    prune(root)
    nodes = score(root)
    rank = lambda n: n.score * (1 - n.link_chars / max(1, n.chars))
    best = max((n for n in nodes if n.chars and n.tag not in INLINE and n.score > 0), key=rank, default=root)
    # an article, or the page's main part, is one container however it is divided
    up, home = best, None
    while up:
        if up.tag == "article" or up.tag == "main" and not home:
            home = up
        up = up.parent
    best = home or best
    kept = [best]
    if best.parent and best.tag not in ("article", "main", "body", "html"):
        least = SIBLING_SHARE * rank(best)
        kept, line = [], []
        for c in [*best.parent.children, None]:
            if isinstance(c, str) or c and c.tag in INLINE and c is not best:
                line.append(c)
                continue
            # bare text and the inline elements in it are one paragraph
            kept += [None, *line] if _prose_line(line) else []
            line = []
            if c and (c is best or not c.cut and (rank(c) >= least > 0 or _prose(c))):
                kept += [None, c]
    return "\n\n".join(blocks(kept))


def _prose(node: Node) -> bool:
    """Headings, and text with few links."""
    return bool(re.fullmatch(r"h[1-6]", node.tag)) or node.chars > 0 and node.link_chars < MOST_LINKS * node.chars


def _prose_line(line: list) -> bool:
    nodes = [c for c in line if isinstance(c, Node) and not c.cut]
    chars = sum(len(c.strip()) for c in line if isinstance(c, str)) + sum(c.chars for c in nodes)
    return chars > 0 and sum(c.link_chars for c in nodes) < MOST_LINKS * chars


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""

    def run(batch):
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pick(pages, page_id="long", url="string", html="string"), run, "page_id long, url string, text string, n_chars long")
