"""A small tolerant HTML tree: tags, signatures and text blocks."""

from __future__ import annotations

import html
import re
from collections import Counter

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select summary table tbody td "
                  "tfoot th thead tr ul".split())
#: An opening tag ends these open elements, if no container stands between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
CONTAINER = frozenset("ul ol dl table select div article section body main aside nav header footer form blockquote".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*>)|<[!?/][^>]*>", re.S)
#: A comment that nothing ends, where no tag can end either.
OPEN_COMMENT = re.compile(r"<!--.*()()()\Z", re.S)
#: One attribute: its name, and its value if it has one. Values are consumed, so no name is looked for in them.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAMING = frozenset(("class", "id", "role"))


class Node:
    """tag, names (class, id and role words), and parts: texts and child nodes in order."""
    __slots__ = ("tag", "names", "parts")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.parts = tag, names, []

    @property
    def signature(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def names_of(attributes: str) -> str:
    found = " ".join(v.strip("\"'") for name, v in ATTRIBUTE.findall(attributes) if name.lower() in NAMING)
    return " ".join(re.sub(r"[0-9]+", "", found.lower()).split())


def parse(text: str) -> Node:
    """The tree of ``text``; never fails. A tag cut off at the end is dropped,
    and what isn't a tag is text."""
    root = Node("#root")
    stack, at, last = [root], 0, text.rfind(">")
    open_tags: Counter = Counter()  # so that a tag without an open element costs no look through the stack

    def close(k: int) -> None:
        for node in stack[k:]:
            open_tags[node.tag] -= 1
        del stack[k:]

    while True:
        m = (TAG if at <= last else OPEN_COMMENT).search(text, at)
        chunk = text[at:m.start() if m else len(text)]
        if m is None:
            cut = re.search(r"<[/!]?[a-zA-Z][^>]*\Z", chunk)
            chunk = chunk[:cut.start()] if cut else chunk
        if chunk:
            stack[-1].parts.append(html.unescape(chunk))
        if m is None:
            return root
        at, tag = m.end(), (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):  # an end tag closes the nearest open element of its name
            if open_tags[tag]:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            continue
        ends = {"p"} | ENDS.get(tag, set()) if tag in BLOCK and tag != "br" else set()
        if any(open_tags[t] for t in ends):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in CONTAINER:
                    break
        node = Node(tag, names_of(m.group(3)) if m.group(3) != ">" else "")
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
            at = end.end() if end else len(text)
        elif tag not in VOID and not m.group(3).endswith("/>"):
            stack.append(node)
            open_tags[tag] += 1


def blocks(node: Node, drop) -> list[str]:
    """Texts of the blocks below ``node`` in page order, white space made one
    space; elements for which ``drop(child, parent)`` holds are left out."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()
    todo: list = [iter(node.parts)]
    open_nodes = [node]
    while todo:
        part = next(todo[-1], None)
        if part is None:
            todo.pop()
            if open_nodes.pop().tag in BLOCK:
                flush()
        elif isinstance(part, str):
            line.append(part)
        elif part.tag in RAW or drop(part, open_nodes[-1]):
            if part.tag in BLOCK:
                flush()
        else:
            if part.tag in BLOCK:
                flush()
            todo.append(iter(part.parts))
            open_nodes.append(part)
    flush()
    return out
