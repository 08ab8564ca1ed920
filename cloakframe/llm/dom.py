"""A lenient HTML tree: elements in page order, and blocks of text between block boundaries."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object".split())
HIDDEN = frozenset("head script style title noscript template svg math iframe object textarea select option button datalist canvas audio video map noembed noframes xmp".split())
#: Elements that a slash before the closing bracket ends.
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul".split()
)
#: An opening tag that ends an open one of these, up to one of those.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Attribute by which training pages tell the article's pieces.
MARK = " data-main-piece"
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?>[^>"']|"[^"]*"|'[^']*')*)>|</?[A-Za-z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: A slash that belongs to an unquoted value.
_ENDS_IN_VALUE = re.compile(r"""=\s*[^\s"'>]*/\Z""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...] = ()
    hidden: bool = False
    children: int = 0
    end: int = 0  # nodes of the subtree: [own, end)
    mark: bool = False  # has the attribute MARK


@dataclass(slots=True)
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (node that holds the text, block number, text): in page order.
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The tree of ``source``. Whatever is open at the end ends there; a closing tag
    without its opening one is passed over."""
    page = Page([Node("#root", -1, 0)])
    nodes, stack, at, block = page.nodes, [0], 0, 0

    def close_to(i: int) -> None:
        while len(stack) > i:
            nodes[stack.pop()].end = len(nodes)

    def add_text(raw: str) -> None:
        if raw and not nodes[stack[-1]].hidden:
            page.texts.append((stack[-1], block, entities.unescape(raw)))

    while True:
        m = _TOKEN.search(source, at)
        if m is None:
            add_text(source[at:])
            break
        add_text(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                t = nodes[stack[i]].tag
                if t == tag:
                    close_to(i)
                    break
                if tag not in BLOCK and t in BLOCK:
                    break
            if tag in BLOCK:
                block += 1
            continue
        if tag in BLOCK:
            block += 1
            if tag not in ("html", "body"):
                for i in range(len(stack) - 1, 0, -1):
                    t = nodes[stack[i]].tag
                    if t == "p":
                        close_to(i)
                        break
                    if t in BLOCK:
                        break
        if tag in CLOSES:
            ends, until = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                t = nodes[stack[i]].tag
                if t in until:
                    break
                if t in ends:
                    close_to(i)
        if tag == "br":
            add_text(" ")
        parent = stack[-1]
        words, unseen = [], nodes[parent].hidden or tag in HIDDEN
        for a in _ATTR.finditer(m[3]) if m[3] else ():
            name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                words += [w.lower() for w in _WORD.findall(value)]
            elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
                unseen = True
        nodes[parent].children += 1
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, tuple(words), unseen, mark=MARK in m[3]))
        if tag in VOID or tag in FOREIGN and m[3].endswith("/") and not _ENDS_IN_VALUE.search(m[3]):
            nodes[-1].end = len(nodes)
            continue
        if tag in RAW:
            done = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            nodes[-1].end = len(nodes)
            at = done.end() if done else len(source)
            continue
        stack.append(len(nodes) - 1)
    close_to(0)
    return page
