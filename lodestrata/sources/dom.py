"""A small document tree on the standard library's HTML parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style", "noscript"))


class Node:
    """An element; its children are elements and strings."""

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    def walk(self) -> Iterator[Node]:
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()

    def strings(self, skip: frozenset[str] = frozenset()) -> Iterator[tuple[str, Node]]:
        for c in self.children:
            if isinstance(c, Node):
                if c.tag not in skip:
                    yield from c.strings(skip)
            else:
                yield c, self

    def text(self, skip: frozenset[str] = frozenset()) -> str:
        """Stripped strings joined by a space."""
        return " ".join(s for s in (t.strip() for t, _ in self.strings(skip)) if s)

    def up(self, *tags: str) -> Node | None:
        n = self.parent
        while n is not None and n.tag not in tags:
            n = n.parent
        return n

    def first(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def with_class(self, name: str) -> Iterator[Node]:
        return (n for n in self.walk() if name in n.classes())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def body(root: Node) -> Node:
    return root.first("body") or root
