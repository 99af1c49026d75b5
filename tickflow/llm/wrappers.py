"""Union-free regular expressions of page structure: parsing, folding, alignment.

A page is a tree of block elements and text slots. An expression is such a tree whose nodes have how often they occur at least (0 or 1) and
at most (1 or MANY), and whose lists may hold repeated groups. Folding finds repeated siblings and repeated groups of siblings in one list;
aligning two lists matches their longest common subsequence, makes what is left over optional, and folds the result. Both are the same
step for a page's own repetitions and for two pages of a host.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from html import unescape

MANY = 2
#: Siblings that a repeated group has at most, and the depth from which elements only separate blocks.
WIDTH, DEPTH = 8, 80
#: A group of any order, and how often a kind is in a list before it becomes one.
ANY, OFTEN = "**", 3

# HTML's elements without content, with raw text, and what begins or ends a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = HEADINGS | frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr main menu nav ol p pre search section summary table ul".split())
BLOCKS = CLOSES_P | frozenset("html head body li dt dd tr td th thead tbody tfoot caption colgroup legend optgroup option select button noscript template svg math object canvas audio video".split())
#: What an open element of the same kind is closed by, unless one of these is met first.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody"), ("table",)), "option": (("option",), ("select",)), "body": (("head",), ())}

# Elements, and words in class, id and role, of what is not the article.
ASIDE = frozenset("nav aside footer form button select option menu dialog head script style title textarea noscript template svg iframe object canvas audio video header search".split())
ROLES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar skip",
    "header": "header masthead banner",
    "footer": "footer contentinfo copyright colophon",
    "side": "sidebar aside complementary related recommended recommendations widget widgets share sharing social",
    "notice": "notice notices notification cookie cookies consent gdpr newsletter subscribe subscription signup paywall popup modal overlay alert alertdialog disclaimer",
    "advert": "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promoted",
    "form": "form login search searchbox",
    "comment": "comment comments commentlist respond replies reply disqus",
    "main": "main articlebody",
}
WORD_ROLE = {w: role for role, words in ROLES.items() for w in words.split()}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("key", "lo", "hi", "kids", "own")

    def __init__(self, key: str, lo: int = 1, hi: int = 1, kids: list | None = None, own: list | None = None):
        self.key, self.lo, self.hi, self.kids, self.own = key, lo, hi, kids if kids is not None else [], own if own is not None else []

    @property
    def tag(self) -> str:
        return self.key.split(".", 1)[0]

    @property
    def role(self) -> str:
        return self.key.split(".")[1] if "." in self.key and self.key[0] != "*" else ""


def _key(tag: str, attributes: str) -> str:
    """The element's name, its role, and the first word of its class or id, without digits."""
    role = name = ""
    for m in _NAMED.finditer(attributes) if "=" in attributes else ():
        words = _WORDS.findall(_CAMEL.sub(" ", m[2] or m[3] or m[4] or "").lower())
        role = role or next((WORD_ROLE[w] for w in words if w in WORD_ROLE), "")
        name = name or (words[0] if words and m[1].lower() in ("class", "id") else "")
    return f"{tag}.{role}.{name}" if role or name else tag


def parse(html: str) -> tuple[Node, list[tuple[str, int]]]:
    """The tree of block elements, and its blocks of text in page order as (text, letters in links). A text node's `own` is its block.

    White space in a block is one space; comments, scripts, styles and all other markup go. Elements left open are closed as HTML has it,
    and a tag that the page's end cuts off is dropped."""
    root = Node("page")
    stack, blocks = [root], []
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                stack[-1].kids.append(Node("#", own=[len(blocks)]))
                blocks.append((text, linked))
            parts.clear()
        linked = 0

    def close(kinds: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in kinds:
                del stack[k:]
                return
            if stack[k].tag in stops:
                return

    at, end = 0, len(html)
    while at < end:
        m = _MARKUP.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text) if in_link else 0
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag or not m[0].endswith(">"):
            continue
        if m[1] or m[4]:
            if tag in BLOCKS:
                flush()
                close(tuple(HEADINGS) if tag in HEADINGS else (tag,), () if tag in ("table", "html", "body") else ("table",) if tag in ("td", "th", "tr", "tbody", "thead", "tfoot") else ("td", "th", "table"))
            elif tag == "a":
                in_link = False
            elif tag in ("span", "ins") and stack[-1].tag == tag:
                flush()
                stack.pop()
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in RAW:
            gone = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = gone.start() if gone else end
        elif tag in BLOCKS:
            flush()
            if tag in CLOSES_P:
                close(("p",), ("td", "th", "table", "button"))
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if tag not in VOID:
                key = _key(tag, m[3] or "")
                if len(stack) < DEPTH or tag in ASIDE or key != tag:
                    node = Node(key)
                    stack[min(len(stack), DEPTH) - 1].kids.append(node)
                    stack.append(node)
        elif tag == "a":
            in_link = True
        elif tag in ("span", "ins") and "=" in (m[3] or "") and (key := _key(tag, m[3])).count(".") == 2 and key.split(".")[1]:
            flush()
            stack[min(len(stack), DEPTH) - 1].kids.append(node := Node(key))
            stack.append(node)
    flush()
    return root, blocks


def _merged(a: Node, b: Node) -> Node:
    a.lo, a.hi = min(a.lo, b.lo), max(a.hi, b.hi)
    a.kids = _each(a.kids + b.kids) if a.key == ANY else align(a.kids, b.kids) if a.kids or b.kids else []
    a.own += b.own
    return a


def _follows(a: Node, b: Node) -> Node:
    """Two neighbours as one repeated node."""
    lo = max(a.lo, b.lo)
    a = _merged(a, b)
    a.lo, a.hi = lo, MANY
    return a


def _each_of(n: Node) -> list[Node]:
    return [x for k in n.kids for x in _each_of(k)] if n.key[0] == "*" else [n]


def _each(nodes: list[Node]) -> list[Node]:
    """One optional node of each kind, by kind; groups are taken apart."""
    found: dict[str, Node] = {}
    for n in nodes:
        for k in _each(n.kids) if n.key[0] == "*" else [n]:
            found[k.key] = _follows(found[k.key], k) if k.key in found else k
    for n in found.values():
        n.lo = 0
    return [found[k] for k in sorted(found)]


def _loose(nodes: list[Node]) -> list[Node]:
    """nodes in which no kind occurs over OFTEN times: from the first to the last of such kinds, any order goes, as a repeated group of one
    optional node of each kind. So the size of an expression follows the kinds of elements, not the number of pages."""
    kinds = [[k.key for k in _each_of(n)] for n in nodes]
    times = Counter(x for own in kinds for x in own)
    at = [k for k, own in enumerate(kinds) if any(times[x] > OFTEN for x in own)] if len(nodes) > OFTEN else []
    return nodes if not at else [*nodes[: at[0]], Node(ANY, 1, MANY, _each(nodes[at[0] : at[-1] + 1])), *nodes[at[-1] + 1 :]]


def fold(nodes: list[Node]) -> list[Node]:
    """Neighbours of one kind as one repeated node, then repeated sequences of neighbours as one repeated group, and what is still repeated
    over and over as a group of any order."""
    for width in range(1, WIDTH + 1):
        if len(nodes) < 2 * width:
            break
        out: list[Node] = []
        at, keys = 0, [n.key for n in nodes]
        while at < len(nodes):
            own = keys[at : at + width]
            if keys[at + width : at + 2 * width] != own or len(own) < width:
                out.append(nodes[at])
                at += 1
                continue
            group, at = nodes[at : at + width], at + width
            while keys[at : at + width] == own:
                group = [_follows(a, b) if width == 1 else _merged(a, b) for a, b in zip(group, nodes[at : at + width], strict=True)]
                at += width
            out += group if width == 1 else [Node("*" + "|".join(own), 1, MANY, group)]
        nodes = out
    return _loose(nodes)


def _regrouped(nodes: list[Node], others: list[Node]) -> list[Node]:
    """nodes with groups for the sequences that are repeated groups among the others."""
    for group in [n for n in others if n.key == ANY]:
        kinds = {k.key for k in group.kids} | {ANY}
        fit = [n.key in kinds or n.key[0] == "*" and {k.key for k in n.kids} <= kinds for n in nodes]
        runs = [(a, b) for a in range(len(nodes)) if fit[a] and not (a and fit[a - 1]) for b in [next((j for j in range(a, len(nodes)) if not fit[j]), len(nodes))]]
        if runs and not any(n.key == ANY for n in nodes):
            a, b = max(runs, key=lambda r: (r[1] - r[0], -r[0]))
            nodes = [*nodes[:a], Node(ANY, 1, 1, _each(nodes[a:b])), *nodes[b:]]
    for group in [n for n in others if n.key[0] == "*" and n.key != ANY]:
        own, keys = [k.key for k in group.kids], [n.key for n in nodes]
        at = 0
        while own and at + len(own) <= len(nodes):
            if keys[at : at + len(own)] == own:
                nodes = [*nodes[:at], Node(group.key, 1, 1, nodes[at : at + len(own)]), *nodes[at + len(own) :]]
                keys = [n.key for n in nodes]
            at += 1
    return nodes


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """One list for two: what both have in the same order is merged, what only one has is optional."""
    a, b = _regrouped(a, b), _regrouped(b, a)
    first = 0
    while first < min(len(a), len(b)) and a[first].key == b[first].key:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last].key == b[-1 - last].key:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    size = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below, key = size[i], size[i + 1], x[i].key
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if key == y[j].key else below[j] if below[j] >= row[j + 1] else row[j + 1]
    out = [_merged(p, q) for p, q in zip(a[:first], b[:first], strict=True)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i].key == y[j].key:
            out.append(_merged(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and size[i + 1][j] >= size[i][j + 1]:
            x[i].lo = 0
            out.append(x[i])
            i += 1
        else:
            y[j].lo = 0
            out.append(y[j])
            j += 1
    out += [_merged(p, q) for p, q in zip(a[len(a) - last :], b[len(b) - last :], strict=True)]
    return fold(out)


def folded(node: Node) -> Node:
    """The page's own repetitions, from the leaves up."""
    for k in node.kids:
        folded(k)
    node.kids = fold(node.kids)
    return node


def slots(node: Node) -> list[Node]:
    """The text slots in order."""
    return [node] if node.key == "#" else [s for k in node.kids for s in slots(k)]


def dump(node: Node) -> str:
    def plain(n: Node) -> list:
        return [n.key, n.lo, n.hi, [plain(k) for k in n.kids]]

    return json.dumps(plain(node), separators=(",", ":"))


def load(text: str) -> Node:
    def made(x: list) -> Node:
        return Node(x[0], x[1], x[2], [made(k) for k in x[3]])

    return made(json.loads(text))
