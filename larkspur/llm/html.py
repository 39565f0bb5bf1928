"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph gives points for its length and its
commas to the element that holds it and, in shrinking shares, to the elements
above. An element's score is discounted by the share of its text that is links.
The best element, or the article or main element around it, and those siblings
that belong to it are kept, without the parts that are menus, adverts, forms,
comments and the like. A name does not take out what holds most
of the page's paragraphs, unless it is beside an article.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Scans stop at the next "<" outside quotes; a quoted value ends at the next quote, wherever that is.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<([a-zA-Z][^\s/<>]*+)([^<>]*+)>|</([a-zA-Z][^\s/<>]*+)[^<>]*+>|<[!?/][^<>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Fixed by HTML: elements without content, with raw content, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote li td th dd dt figcaption".split()) | HEADINGS
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
           "tfoot": {"tbody", "tr", "td", "th"}}
_NOTHING: frozenset = frozenset()
_P = frozenset({"p"})
_BARRIERS = frozenset("table ul ol dl menu select article section div body td th blockquote".split())

#: Elements, roles and name parts that are never the article.
_APART = frozenset(
    "script style noscript iframe textarea title head nav footer aside form button select option input label dialog menu "
    "template object embed svg canvas audio video map fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar "
                   "status".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion promoted "
    "banner cookie cookies consent gdpr privacy notice notices notification alert warning popup modal overlay lightbox sidebar "
    "rail widget widgets menu submenu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead topbar "
    "footer copyright disclaimer comment comments commentlist reply replies respond disqus discussion share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login register search toolbar skip "
    "paywall outbrain taboola".split())
_GOOD = frozenset("article content main body post entry story text page".split())
_COMMENT_HEADING = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user)\s+)?(?:comments?|replies|responses|discussion|kommentare?|leserkommentare|commentaires?|comentarios?|"
    r"related(?: articles| posts| stories)?|see also|more from|advertisement)\b[\s\d():.]*\Z", re.I)

#: Name parts of talk below an article, and words that make another part a mere property of the page.
_TALK = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
_PROPERTY = frozenset("no has have with without is open opened closed on off hide hidden enabled disabled".split())
#: Blocks that go on a text beside its best container.
_GOES_ON = frozenset("section ul ol dl pre blockquote table figure header hgroup".split())

_LEVELS = 5
_SIBLING_SHARE = 0.2
_LINKS_ONLY = 0.75


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "children", "score", "text", "linked", "links")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.names: frozenset = frozenset()
        self.role, self.hidden = "", False
        self.score, self.text, self.linked, self.links = 0.0, 0, 0, 0
        if attributes and not attributes.isspace():
            for name, value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    self.names |= frozenset(w.lower() for w in _WORD.findall(html.unescape(value)))
                elif name == "role":
                    self.role = value.strip().lower()
                elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    self.hidden = True


def parse(page: str) -> Node:
    """A tree of elements and decoded texts; unclosed and misplaced tags are borne."""
    root = Node("html", "", None)
    path, open_tags = [root], Counter()
    at, length = 0, len(page)

    def leave(depth: int) -> None:
        while len(path) > depth:
            open_tags[path.pop().tag] -= 1

    while at < length:
        found = _TOKEN.search(page, at)
        start = found.start() if found else length
        if start > at:
            path[-1].children.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        tag = (found[1] or found[3] or "").lower()
        if tag:
            closes = _CLOSES.get(tag, _NOTHING) | _P if tag in BLOCKS else _NOTHING
            if any(open_tags[c] for c in closes):
                for depth in range(len(path) - 1, 0, -1):
                    name = path[depth].tag
                    if name in closes:
                        leave(depth)
                        if name == "p" and len(closes) == 1:
                            break
                    elif name in _BARRIERS:
                        break
            attributes = found[2] or found[4] or ""
            node = Node(tag, attributes, path[-1])
            path[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[^<>]*>", re.I).search(page, at)
                node.children.append(page[at:end.start() if end else length])
                at = end.end() if end else length
            elif tag not in VOID and not attributes.endswith("/"):
                path.append(node)
                open_tags[tag] += 1
        elif found[5] and open_tags[found[5].lower()]:
            tag, depth = found[5].lower(), len(path) - 1
            while path[depth].tag != tag:
                depth -= 1
            leave(depth)
    return root


def _apart(node: Node, in_article: bool) -> bool:
    if node.tag in ("article", "main", "body", "html"):
        return node.hidden
    if node.tag in _APART or node.hidden or node.role in _ROLES:
        return True
    return node.tag == "header" and not in_article


def _named_apart(node: Node) -> bool:
    return bool(node.names & _NAMES) and node.tag not in HEADINGS and node.tag not in ("article", "main", "body", "html")


def _walk(root: Node, apart) -> list[Node]:
    """Take out what is ``apart``; the rest, each element before those in it."""
    stack, order = [(root, False)], []
    while stack:
        node, inside = stack.pop()
        order.append(node)
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if not isinstance(c, Node) or not apart(c, inside)]
        stack.extend((c, inside) for c in node.children if isinstance(c, Node))
    return order


def _held(root: Node, order: list[Node]) -> dict[int, float]:
    """Points of the paragraphs in each element, less the share of links in each paragraph."""
    size, linked, held = {}, {}, {}
    for node in reversed(order):
        own = [c for c in node.children if isinstance(c, Node)]
        size[id(node)] = sum(size[id(c)] for c in own) + sum(len(c.strip()) for c in node.children if isinstance(c, str))
        linked[id(node)] = size[id(node)] if node.tag == "a" else sum(linked[id(c)] for c in own)
    for owner, text in blocks(root):
        if owner.tag not in HEADINGS and size[id(owner)]:
            held[id(owner)] = held.get(id(owner), 0.0) + points(text) * (1 - linked[id(owner)] / size[id(owner)])
    for node in reversed(order):
        if node.parent is not None:
            held[id(node.parent)] = held.get(id(node.parent), 0.0) + held.get(id(node), 0.0)
    return held


def _prune(root: Node) -> None:
    """Take out parts that are never the article, then what is only links."""
    order = _walk(root, _apart)
    if any(map(_named_apart, order)):
        held = _held(root, order)
        most = held.get(id(root), 0.0) / 2
        around = set()
        for node in order:
            if node.tag in ("article", "main") and held.get(id(node)):
                while node is not None and id(node) not in around:
                    around.add(id(node))
                    node = node.parent

        def named(node: Node, inside: bool) -> bool:
            beside = around and not inside and id(node) not in around
            text = held.get(id(node), 0.0) > most and not beside and (
                not node.names & _TALK or node.names & (_GOOD | _PROPERTY))
            return _named_apart(node) and not text

        order = _walk(root, named)
    for node in reversed(order):
        node.text = node.linked = node.links = 0
        kept = []
        for child in node.children:
            if isinstance(child, Node):
                listed = child.tag in BLOCKS and child.tag not in _PARAGRAPHS and child.tag not in ("article", "main", "body")
                if listed and child.links > 1 and child.linked >= _LINKS_ONLY * child.text or listed and _is_comments(child):
                    continue
                node.text += child.text
                node.linked += child.text if child.tag == "a" else child.linked
                node.links += child.links + (child.tag == "a")
            else:
                node.text += len(child.strip())
            kept.append(child)
        node.children = kept


def _is_comments(node: Node) -> bool:
    for child in node.children:
        if isinstance(child, Node):
            if child.tag in HEADINGS:
                return bool(_COMMENT_HEADING.match(_flat(child)))
            if child.text:
                return False
        elif child.strip():
            return False
    return False


def _flat(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        part = stack.pop()
        if isinstance(part, Node):
            stack.extend(reversed(part.children))
        else:
            out.append(part)
    return " ".join("".join(out).split())


def blocks(node: Node) -> list[tuple[Node, str]]:
    """Texts between block bounds in page order, each with the innermost block around it."""
    out, current, owner = [], [], node
    stack: list = [(node, True)]

    def flush():
        text = " ".join("".join(current).split())
        if text:
            out.append((owner, text))
        current.clear()

    while stack:
        part, opening = stack.pop()
        if isinstance(part, str):
            current.append(part)
        elif part.tag == "br":
            current.append(" ")
        elif part.tag in BLOCKS:
            flush()
            if opening:
                owner = part
                stack.append((part, False))
                stack.extend((c, True) for c in reversed(part.children))
            else:
                owner = part.parent or part
        else:
            stack.extend((c, True) for c in reversed(part.children))
    flush()
    return out


def points(text: str) -> float:
    """One for a paragraph of 25 characters, one for each comma, one per hundred characters up to three."""
    return min(len(text) / 25, 1.0) + text.count(",") + min(len(text) / 100, 3.0)


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by line feeds; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    scored: dict[int, Node] = {}
    for owner, text in blocks(root):
        if owner.tag in HEADINGS:
            continue
        node = owner.parent if owner.tag in _PARAGRAPHS and owner.parent is not None else owner
        share = points(text)
        for level in range(_LEVELS):
            if node is None:
                break
            node.score += share / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[id(node)] = node
            node = node.parent
    if not scored:
        kept = [root]
    else:
        for node in scored.values():
            node.score *= 1 - (node.linked / node.text if node.text else 0)
            if node.tag in ("article", "main") or node.names & _GOOD:
                node.score *= 1.25
        best = max(scored.values(), key=lambda n: n.score)
        while best.parent is not None and best.parent.tag not in ("body", "html") and best.parent.score >= 0.75 * best.score:
            best = best.parent
        best = _article(best)
        kept = [best]
        if best.parent is not None:
            beside = best.parent.children
            sure = {i for i, child in enumerate(beside) if child is best or isinstance(child, Node) and _belongs(child, best)}
            first, last = min(sure), max(sure)
            kept = [child for i, child in enumerate(beside) if i in sure or first < i < last and _goes_on(child)]
    return "\n".join(text for node in kept for _, text in blocks(node))


def _article(best: Node) -> Node:
    """The article or main element next around the best container; the container if there is none."""
    node = best
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return best if node is None else node


def _goes_on(node: Node | str) -> bool:
    """Whether a part between kept ones is text, not links."""
    return isinstance(node, Node) and node.linked < 0.25 * max(node.text, 1)


def _belongs(node: Node, best: Node) -> bool:
    """Beside a container that is one of several parts, paragraphs, headings, sections and lists belong to it at any length."""
    if node.tag == "h1":
        return True
    if best.tag not in ("article", "main") and (
            node.tag == "p" or node.tag in HEADINGS or node.tag in _GOES_ON):
        return _goes_on(node)
    if node.tag == "p" or node.tag in HEADINGS:
        return node.text > 80 and node.linked < 0.25 * node.text
    return node.score >= max(1.0, _SIBLING_SHARE * best.score) and node.linked < 0.25 * max(node.text, 1)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with _text, the main text of the whole page, which replaces a column of that name.

    A null or empty page gives an empty text.
    """
    pages = pages.drop("_text")

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(main_text, na_action=None).astype(object)

    return pages.select("*", text(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("_text"))
