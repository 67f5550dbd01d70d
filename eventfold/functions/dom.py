"""A small tree of an HTML page on the standard parser."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(("script", "style"))


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """All elements below, in order of the page."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            n = todo.pop()
            yield n
            todo += [c for c in reversed(n.children) if isinstance(c, Node)]

    def all(self, *tags: str, having: Callable[[Node], bool] | None = None) -> list[Node]:
        return [n for n in self.walk() if (not tags or n.tag in tags) and (having is None or having(n))]

    def first(self, *tags: str, having: Callable[[Node], bool] | None = None) -> Node | None:
        return next((n for n in self.walk() if (not tags or n.tag in tags) and (having is None or having(n))), None)

    def strings(self) -> Iterator[str]:
        todo: list[Node | str] = list(reversed(self.children))
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                yield n
            else:
                todo += reversed(n.children)

    def pieces(self) -> Iterator[tuple[Node, str]]:
        """All texts below with the elements that they stand in, in order of the page."""
        todo: list[tuple[Node, Node | str]] = [(self, c) for c in reversed(self.children)]
        while todo:
            at, n = todo.pop()
            if isinstance(n, str):
                yield at, n
            else:
                todo += [(n, c) for c in reversed(n.children)]

    def text(self) -> str:
        """What can be read, in one line."""
        return " ".join(" ".join(self.strings()).split())

    def ancestors(self) -> Iterator[Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent

    def above(self, *tags: str) -> Node | None:
        n = self.parent
        while n is not None and n.tag not in tags:
            n = n.parent
        return n

    def without(self, gone: Callable[[Node], bool]) -> Node:
        """Takes out elements, here."""
        todo = [self]
        while todo:
            n = todo.pop()
            n.children = [c for c in n.children if isinstance(c, str) or not gone(c)]
            todo += [c for c in n.children if isinstance(c, Node)]
        return self

    @property
    def classes(self) -> tuple[str, ...]:
        return tuple(sorted(self.attrs.get("class", "").split()))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


CHROME = re.compile(r"cookiebot|cybot|onetrust|cookie-consent|cookie-banner|gdpr|userway|accessibility-widget", re.I)


SILENT = ("script", "style", "nav", "footer", "iframe", "noscript")


def without_tags(root: Node, *more: str) -> Node:
    """The page without scripts and navigation."""
    gone = {*SILENT, *more}
    return root.without(lambda n: n.tag in gone)


def bare(root: Node, *more: str) -> Node:
    """The page without scripts, navigation and consent boxes."""
    return without_tags(root, *more).without(lambda n: bool(CHROME.search(n.attrs.get("id", "") + " " + n.attrs.get("class", ""))))


def holders(root: Node, tags: tuple[str, ...]) -> set[int]:
    """The ids of elements that have one of the tags below them."""
    out: set[int] = set()
    for n in root.walk():
        if n.tag in tags:
            for up in n.ancestors():
                if id(up) in out:
                    break
                out.add(id(up))
    return out


def main(root: Node) -> Node:
    return root.first("main") or root.first(having=lambda n: n.attrs.get("role") == "main") or root.first("article") or root.first("body") or root
