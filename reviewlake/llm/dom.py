"""A small tolerant HTML reader: elements and blocks of text as one tree in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: One markup token; comments, declarations and raw text elements are taken whole. Possessive, so linear.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>script|style|template|svg|iframe|textarea|head)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)[^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr br "
    "math semantics annotation mrow mi mn mo ms mtext mspace mstyle mpadded msup msub msubsup mfrac msqrt mroot mover munder munderover".split()
)
#: An open element of the value is closed when the key begins.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
HOLDERS = set("ul ol dl table body article section div main aside nav header footer form select".split())


@dataclass
class Node:
    """An element (``text`` is None) or a block of text."""

    tag: str
    parent: int
    hint: str = ""
    text: str | None = None
    linked: int = 0
    children: list[int] = field(default_factory=list)


def parse(page: str | None) -> list[Node]:
    """Nodes in page order; node 0 is the root. Unclosed and stray tags are tolerated.

    Text gathers in its nearest block element until a block begins or ends; inline tags do not part it, a
    line break counts as white space. Character references are decoded, white space becomes one space.
    Raw elements are left out up to their closing tag; without one, only script and style take the rest of the page.
    """
    nodes = [Node("#root", -1)]
    open_at = [0]  # indexes of open block elements
    names: list[tuple[str, int]] = []  # open elements of all kinds: name, depth of blocks before it
    pieces: list[str] = []
    links = linked = 0

    def add(node: Node) -> int:
        nodes.append(node)
        nodes[node.parent].children.append(len(nodes) - 1)
        return len(nodes) - 1

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            add(Node("#text", open_at[-1], text=text, linked=min(linked, len(text))))
        pieces.clear()
        linked = 0

    def close_to(depth: int) -> None:
        nonlocal links
        flush_needed = any(name not in INLINE for name, _ in names[depth:])
        if flush_needed:
            flush()
        for name, blocks in reversed(names[depth:]):
            if name == "a":
                links -= 1
            elif name not in INLINE:
                del open_at[blocks:]
        del names[depth:]

    page = page or ""
    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            piece = html.unescape(page[at:mark])
            pieces.append(piece)
            if links:
                linked += len(piece)
        if mark == end:
            break
        token = MARKUP.match(page, mark)
        if token is None:
            pieces.append("<")
            at = mark + 1
            continue
        at = token.end()
        if token["raw"]:
            raw = token["raw"].lower()
            if raw == "svg" and token[0].endswith("/>"):
                continue
            stop = re.compile(rf"</{raw}\s*>", re.I).search(page, at)
            at = stop.end() if stop else (end if raw in ("script", "style") else at)
            if raw in ("iframe", "textarea", "head"):
                flush()
            continue
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        if token["close"] or token["close2"]:
            depth = next((i for i in range(len(names) - 1, -1, -1) if names[i][0] == name), None)
            if depth is not None and not (name in INLINE and any(n in HOLDERS for n, _ in names[depth + 1 :])):
                close_to(depth)
            elif name == "p":
                flush()
            continue
        rest = token["rest"] or ""
        if name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            for i in range(len(names) - 1, -1, -1):
                if names[i][0] in CLOSES.get(name, ()):
                    close_to(i)
                    break
                if names[i][0] in HOLDERS:
                    break
            for i in range(len(names) - 1, -1, -1):
                if names[i][0] == "p":
                    close_to(i)
                    break
                if names[i][0] in HOLDERS or names[i][0] in ("li", "td", "th", "dd"):
                    break
            flush()
            words = []
            for kind, *values in ATTRIBUTE.findall(rest) if rest else ():
                words.append(kind.lower() if kind.lower() == "hidden" else " ".join(values))
            names.append((name, len(open_at)))
            open_at.append(add(Node(name, open_at[-1], " ".join(words).lower())))
        else:
            names.append((name, len(open_at)))
            links += name == "a"
    flush()
    return nodes
