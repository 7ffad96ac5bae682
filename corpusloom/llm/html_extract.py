"""Main text of web pages by tree scoring.

The page is parsed into a tree. Every paragraph-like block earns points (one, one for each comma, up to three for
length), which it passes to its ancestors, halved at each step up; an element's points are discounted by its link
density. The best container wins; if it lies in an ``article`` or ``main``, that element stands for it. Of the winner's
siblings those are kept that score like it or are the same kind of element, that stand between kept ones with few links, that are headings before it,
or that are plain text blocks beside it. Menus, page headers and footers, sidebars, notices, adverts, forms and reader
comments are cut off before scoring. Outside an article they are told by element, role or the words of a class or id, unless
the words are parts of longer names and it holds most of the page's unlinked text. Inside one they are told by element, role or a class
name all of whose words speak of such parts ("post-comments", "ad_box-2"), or one of whose words does while most of the element's text is links; reader
comments and adverts also by such an id. So a heading or section that merely speaks of "related" or "social" things stays ("related-work").

Comments, declarations, marked sections and processing instructions are no text, up to their end or that of the page. Markup that is
malformed in any other way is read as it comes, and none is an error.

Every step is linear in the page: the parser counts the open elements of each scope and looks for one to close only if it
is open, and all measures of an element are sums over its children.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from .textkit import map_rows

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page's, wherever they stand.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea iframe svg object canvas audio video"
    " dialog datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Text blocks that are kept beside the winner if they hold few links.
PLAIN = frozenset("p ul ol dl table blockquote pre figure".split())
#: Elements whose open children an end tag of an inline element outside them doesn't close.
SCOPES = frozenset("#root td th article body".split())
#: Elements that a start tag ends if they are open: (closes, up to).
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_STOPS = {"table", "td", "th", "button", "object", "article", "section", "div", "li", "blockquote", "form"}
_H_STOPS = {"table", "td", "article", "section", "div", "li"}
#: Words of class, id and role of what isn't the article.
OTHER = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?\w*|consent|gdpr|notice|notification|alert|popup|modal|overlay"
    r"|nav|navbar|navigation|menu\w*|breadcrumbs?|pagination|pager|toolbar|topbar|masthead|sidebar|side|widget|aside|complementary"
    r"|footer|contentinfo|comments?|comment-?list|respond|replies|disqus|share|sharing|social|related|recommend\w*"
    r"|newsletter|subscribe|signup|login|search|skip-?link)(?:$|[^a-z])",
    re.I,
)
#: Whole class names of the same, which hold inside an article too.
INSIDE = frozenset(
    "ad ads advert advertisement ad-slot ad-container sponsored sponsor promo banner cookie-notice cookie-banner notice alert popup modal"
    " navbar navigation breadcrumb breadcrumbs pagination sidebar widget comments comment-list comments-area comment-section replies"
    " disqus share sharing share-buttons social social-share social-links related related-posts related-articles related-links"
    " recommended recommendations newsletter newsletter-signup subscribe signup login skip-link".split()
)
#: Words of the class of a reader's comment or an advert, of other parts that aren't the article's, and words that say nothing beside them.
FOREIGN = frozenset(
    "comment comments commentlist commenting disqus respond reply replies ad ads adbox adslot adunit advert adverts advertisement advertisements"
    " advertising adsense sponsor sponsors sponsored sponsorship".split()
)
FURNITURE = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager footer sidebar promo promos promotion widget widgets toolbar"
    " topbar masthead newsletter subscribe subscription signup login popup modal overlay share sharing social cookie cookies consent gdpr notice".split()
)
NEUTRAL = frozenset(
    "post posts user users reader readers article articles entry page pages site main primary secondary global local top bottom left right upper lower"
    " inner outer side box boxes banner slot container wrapper wrap area areas section sections block blocks list lists item items bar bars link links unit"
    " group holder zone space row col column grid card panel header body title label form thread threads tree count mobile desktop tablet sticky fixed inline"
    " native text image google in the of js small large mini big new all more content node module component".split()
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PARTS = re.compile(r"[^A-Za-z]+")
COMMENT_IDS = frozenset("comments comment-list comment-section respond disqus_thread".split())
ROLES = frozenset("navigation complementary contentinfo banner search dialog alertdialog alert".split())
PAGE_HEADER = re.compile(r"(?:^|[^a-z])(?:site-?header|page-?header|header|banner)(?:$|[^a-z])", re.I)
BODY_NAMES = re.compile(r"(?:^|[^a-z])(?:article|main|content|post|entry|story|body)(?:$|[^a-z])", re.I)


class Node:
    """An element. held: whether it stands in an article or main; commas and text of inline content only, text_len and
    link_len of all."""

    __slots__ = ("tag", "attrs", "children", "parent", "scope", "open", "held", "in_article", "points", "text_len", "link_len", "commas", "inline")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.points, self.text_len, self.link_len, self.commas, self.inline = 0.0, 0, 0, 0, 0
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        self.held = parent is not None and (parent.held or parent.tag in ("article", "main"))
        self.open: dict[str, int] = {}
        self.scope: Node = self if parent is None or tag in SCOPES else parent.scope


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        #: Open elements by tag, of the whole page.
        self.open: dict[str, int] = {}

    def _leave(self, node: Node) -> None:
        """Close every open element down to ``node``, which is one of them."""
        at = self.at
        while True:
            self.open[at.tag] -= 1
            if at.parent is not None:
                at.parent.scope.open[at.tag] -= 1
            if at is node:
                break
            at = at.parent
        self.at = node.parent

    def _close(self, tags: set[str], stop: set[str], outermost: bool = False) -> None:
        if not any(self.open.get(t) for t in tags):
            return
        node, last = self.at, None
        while node.parent is not None and node.tag not in stop:
            if node.tag in tags:
                last = node
                if not outermost:
                    break
            node = node.parent
        if last is not None:
            self._leave(last)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close({"p"}, _P_STOPS)
            if tag in HEADINGS:
                self._close(HEADINGS, _H_STOPS)
        if tag in CLOSES:
            self._close(*CLOSES[tag], outermost=True)
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.open[tag] = self.open.get(tag, 0) + 1
            own = self.at.scope.open
            own[tag] = own.get(tag, 0) + 1
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open.get(tag) or (tag not in BLOCKS and self.at.tag != tag and not self.at.scope.open.get(tag)):
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._leave(node)

    def parse_html_declaration(self, i):
        return self.parse_comment(i) if self.rawdata.startswith("<!--", i) else self.parse_bogus_comment(i)

    def parse_comment(self, i, report=1):
        return self._whole(super().parse_comment(i, report))

    def parse_bogus_comment(self, i, report=1):
        return self._whole(super().parse_bogus_comment(i, report))

    def parse_pi(self, i):
        return self._whole(self.rawdata.find(">", i) + 1 or -1)

    def _whole(self, end: int) -> int:
        """The page is fed at once, so what has no end ends with it."""
        return len(self.rawdata) if end < 0 else end

    def handle_data(self, data):
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _order(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def measure(root: Node) -> list[Node]:
    """Set lengths and commas from the leaves up; the nodes in page order."""
    nodes = _order(root)
    for node in nodes:
        node.points, node.text_len, node.link_len, node.commas, node.inline = 0.0, 0, 0, 0, 0
    for node in reversed(nodes):
        own = [" ".join(c.split()) for c in node.children if isinstance(c, str)]
        size, commas = sum(map(len, own)), sum(c.count(",") for c in own)
        node.text_len += size
        node.inline += size
        node.commas += commas
        if node.tag == "a":
            node.link_len = node.text_len
        up = node.parent
        if up is not None:
            up.text_len += node.text_len
            up.link_len += node.link_len
            if node.tag not in BLOCKS:
                up.commas += node.commas
                up.inline += node.inline
    return nodes


def named_other(name: str, words: frozenset[str]) -> bool | None:
    """Whether a class name or id speaks of ``words`` and of nothing else; None if of other things too."""
    parts = {w.lower() for w in _PARTS.split(_CAMEL.sub("-", name)) if w}
    if parts.isdisjoint(words):
        return False
    return True if parts <= FOREIGN | FURNITURE | NEUTRAL else None


def foreign_block(node: Node) -> bool:
    """Whether a block inside an article is a reader's comment, an advert, a menu or the like by its class or id."""
    told = [named_other(name, FOREIGN | FURNITURE) for name in node.attrs.get("class", "").split()]
    if True in told or named_other(node.attrs.get("id", ""), FOREIGN):
        return True
    return None in told and 2 * node.link_len > node.text_len


def unwanted(node: Node, most: float) -> bool:
    """Whether an element isn't the article's; ``most`` is the unlinked text that makes a container more than a name."""
    if node.tag in DROPPED:
        return True
    a = node.attrs
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    if node.tag in ("html", "body", "main") or (node.tag == "article" and not node.in_article):
        return False
    if a.get("role", "").lower() in ROLES:
        return True
    names = a.get("class", "").lower().split()
    if node.held:
        if node.tag in HEADINGS:
            return False
        if not INSIDE.isdisjoint(names) or a.get("id", "").lower() in COMMENT_IDS:
            return True
        return node.tag in BLOCKS and foreign_block(node)
    if node.tag == "header":
        return True
    told = f"{a.get('class', '')} {a.get('id', '')}"
    if not told.strip() or node.tag in HEADINGS:
        return False
    if not INSIDE.isdisjoint(told.lower().split()):
        return True
    return bool(OTHER.search(told) or PAGE_HEADER.search(told)) and node.text_len - node.link_len < most


def prune(root: Node) -> None:
    measure(root)
    kept_text, todo = 0, [root]
    while todo:  # unlinked text outside of what is dropped by its element
        node = todo.pop()
        kept_text += sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str)) if node.tag != "a" else 0
        todo += [c for c in node.children if isinstance(c, Node) and c.tag not in DROPPED and node.tag != "a"]
    most, todo = max(1.0, 0.5 * kept_text), [root]
    while todo:
        node = todo.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not unwanted(c, most)]
        todo += [c for c in node.children if isinstance(c, Node)]


def score(root: Node) -> list[Node]:
    """Set points; the nodes in page order."""
    nodes = measure(root)
    for node in nodes:
        if node.tag not in BLOCKS or not node.inline:
            continue
        points = (1 + node.commas + min(node.inline, 300) / 100) * (1 - min(1.0, node.link_len / node.text_len))
        up, share = node.parent, 1.0
        while up is not None and share > 0.01:
            up.points += points * share
            up, share = up.parent, share / 2
    return nodes


def value(node: Node) -> float:
    """Points discounted by link density, with a bonus for elements named as the article's."""
    named = BODY_NAMES.search(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}")
    held = node.points + (5 if named and node.text_len else 0)
    return held * (1 - (node.link_len / node.text_len if node.text_len else 0))


def kept(root: Node) -> list[Node]:
    """The best container and the siblings that stay, in page order."""
    nodes = score(root)
    boxes = [n for n in nodes if n.tag in BLOCKS and n.tag not in HEADINGS and n.tag not in ("p", "html", "hr") and n.text_len]
    if not boxes:
        return [root]
    best = max(boxes, key=value)
    up: Node | None = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    if best.parent is None or best.tag in ("body", "main"):
        if best.tag == "body":  # lists of nothing but links are menus there
            best.children = [c for c in best.children if isinstance(c, str) or c.tag not in ("ul", "ol", "menu") or c.link_len < c.text_len]
        return [best]
    beside = [c for c in best.parent.children if isinstance(c, Node) and c.text_len]
    few = lambda c, most: c.link_len < most * c.text_len
    least, at = max(10.0, 0.2 * value(best)), beside.index(best)
    name = best.attrs.get("class", "")
    alike = lambda c: c.tag == best.tag and c.attrs.get("class", "") == name and (name or c.tag == "section") and few(c, 0.25)
    stay = [c is best or (value(c) >= least and few(c, 0.5)) or bool(alike(c)) for c in beside]
    if best.tag == "article":
        stay = [s or (c.tag in HEADINGS and i < at) for i, (s, c) in enumerate(zip(stay, beside, strict=True))]
    else:
        first, last = stay.index(True), len(stay) - 1 - stay[::-1].index(True)
        for i, c in enumerate(beside):
            between = first < i < last and few(c, 0.25)
            stay[i] = stay[i] or between or (few(c, 0.25) and (c.tag in PLAIN or (c.tag in HEADINGS and i < last)))
        for i in range(len(beside) - 2, last, -1):  # a heading after it stays with the block that follows
            stay[i] = stay[i] or (beside[i].tag in HEADINGS and stay[i + 1] and few(beside[i], 0.25))
    return [c for c, s in zip(beside, stay, strict=True) if s]


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks under ``node``, white space collapsed, empty ones left out."""
    parts: list[str] = []
    todo: list[tuple[str, Node | str]] = [("in", node)]
    while todo:
        what, x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
            continue
        if x.tag in BLOCKS or what == "end":
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                yield text
        if what == "end":
            continue
        if x.tag == "br":
            parts.append(" ")
        if x.tag in BLOCKS:
            todo.append(("end", x))
        todo += [("in", c) for c in reversed(x.children)]
    text = " ".join("".join(parts).split())
    if text:
        yield text


def main_text(html: str | None) -> str:
    """The article's blocks joined by newlines; empty for null, empty or text-free pages. A page without any container
    (bare text) is its own article."""
    if not html:
        return ""
    root = parse(html)
    prune(root)
    return "\n".join(b for n in kept(root) for b in blocks(n))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row. Repeated rows give repeated results; null ids and urls pass;
    columns other than the three named are not read; no rows give no rows."""
    schema = f"page_id {pages.schema[id_col].dataType.simpleString()}, url {pages.schema[url_col].dataType.simpleString()}, text string, n_chars long"
    return map_rows(pages, [id_col, url_col, html_col], schema, lambda rows: [(i, u, t := main_text(h), len(t)) for i, u, h in rows])
