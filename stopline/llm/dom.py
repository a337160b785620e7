"""A page's elements and texts, as far as telling an article from what surrounds it needs them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole content is no text of the page.
SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video select textarea button title".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
#: Opening one of these ends an open element of the second kind, up to the nearest of the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/\"'>]+)")
_BLANKS = re.compile(r"\s+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: frozenset = frozenset()
    hidden: bool = False
    chars: int = 0
    link_chars: int = 0
    stops: int = 0
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    """``texts``: (element, block, text) in page order; texts of one block belong to one line."""

    nodes: list[Node]
    texts: list[tuple[int, int, str]]

    def text(self, kept) -> str:
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.texts:
            if kept[node]:
                blocks.setdefault(block, []).append(text)
        lines = (_BLANKS.sub(" ", "".join(parts)).strip() for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def _attributes(source: str) -> tuple[frozenset, bool]:
    tokens, hidden = set(), False
    for name, *values, alone in _ATTRIBUTE.findall(source):
        name, value = (name or alone).lower(), html.unescape("".join(values))
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            tokens.update(p.lower() for p in _PARTS.findall(value))
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
    return frozenset(tokens), hidden


def parse(source: str) -> Page:
    """Elements that matter as nodes (0 is the page), formatting elements without class or id as part of their parent."""
    nodes, texts, stack = [Node("page", -1, 0)], [], [0]
    block, links, at, silent = 0, 0, 0, None

    def say(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        here = nodes[stack[-1]]
        shown = len(_BLANKS.sub("", text))
        here.chars += shown
        here.link_chars += shown if links else 0
        here.stops += sum(map(text.count, ".!?;:"))
        texts.append((stack[-1], block, text))

    def close(tags: tuple[str, ...], until: tuple[str, ...] = ()) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[i]].tag
            if tag in tags:
                del stack[i:]
                return True
            if tag in until:
                return False
        return False

    for match in _TOKEN.finditer(source):
        begin, end = match.span()
        if begin < at:
            continue
        if begin > at and silent is None:
            say(source[at:begin])
        at = end
        closing, tag, rest = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if silent is not None:
            if tag == silent and closing:
                silent = None
            elif not (silent == "head" and tag == "body"):
                continue
            else:
                silent = None
        if not closing and tag in SILENT:
            if tag in RAW:
                ends = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(source, at)
                at = ends.end() if ends else len(source)
            elif not rest.rstrip().endswith("/"):
                silent = tag
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            texts.append((stack[-1], block, " "))
            continue
        plain = tag in INLINE
        if not plain:
            block += 1
        if tag in VOID:
            continue
        if closing:
            close((tag,))
            continue
        if plain and ("class" not in rest and "id" not in rest and "style" not in rest and "hidden" not in rest):
            continue
        tokens, hidden = _attributes(rest) if rest.strip() else (frozenset(), False)
        if plain and not tokens and not hidden:
            continue
        if not plain:
            close(("p",), ("div", "section", "article", "td", "li", "blockquote", "main", "aside"))
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if rest.rstrip().endswith("/") and tag not in ("p", "div"):
            continue
        parent = stack[-1]
        nodes.append(Node(tag, parent, nodes[parent].depth + 1, tokens, hidden))
        nodes[parent].children.append(len(nodes) - 1)
        stack.append(len(nodes) - 1)
    if at < len(source) and silent is None:
        say(source[at:])
    return Page(nodes, texts)
