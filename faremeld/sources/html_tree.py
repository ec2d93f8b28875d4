"""A small element tree with descendant selectors, for use inside Spark tasks.

Only what the page readers need: find elements by tag, id, class or attribute
along a descendant path, and read their text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# A new one of these ends an open one of the same kind inside the same parent.
_CLOSES = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "li": ("li",), "p": ("p",), "option": ("option",)}
_SCOPE = {"table", "ul", "ol", "div", "article", "section", "select", "body", "nav"}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([A-Za-z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_RAW = {tag: re.compile(f"</{tag}\\b[^>]*>", re.I) for tag in ("script", "style")}
_PART = re.compile(r"([.#]?)([\w-]+)|\[([\w-]+)(\*=([\w-]+))?\]")


class Page:
    """Elements in page order, as columns, and where each tag, id and class occurs.

    Elements `at + 1` to `ends[at]` are the descendants of element `at`, and
    `pieces[first[at]:last[at]]` is the text in it.
    """

    __slots__ = ("tags", "attrs", "names", "parents", "ends", "first", "last", "pieces", "places")

    def __init__(self):
        self.tags, self.attrs, self.names, self.parents = [], [], [], []
        self.ends, self.first, self.last = [], [], []
        self.pieces, self.places = [], {}


class Node:
    """An element of a page."""

    __slots__ = ("page", "at")

    def __init__(self, page, at):
        self.page, self.at = page, at

    @property
    def tag(self):
        return self.page.tags[self.at]

    @property
    def attrs(self):
        return self.page.attrs[self.at]

    def find_all(self, path):
        steps = _compile(path)
        (names, parts), above = steps[-1], steps[:-1]
        page = self.page
        for i in self._candidates(names):
            if _matches(page, i, names, parts) and _under(page, page.parents[i], above):
                yield Node(page, i)

    def _candidates(self, names):
        """Places below this element that one of the names allows."""
        start, end = self.at + 1, self.page.ends[self.at]
        if not names:
            return range(start, end)
        places = min((self.page.places.get(name, ()) for name in names), key=len)
        return places[bisect_left(places, start) : bisect_left(places, end)]

    def find(self, path):
        return next(self.find_all(path), None)

    def text(self):
        """All text below, pieces joined by a space."""
        page = self.page
        return " ".join(page.pieces[page.first[self.at] : page.last[self.at]])


def parse(html: str) -> Node:
    """Tree of a page. Comments and declarations are left out."""
    html = html or ""
    page = Page()
    tags, attrs, parents, ends, first, last = page.tags, page.attrs, page.parents, page.ends, page.first, page.last
    names_of, pieces, places = page.names, page.pieces, page.places

    def rise(here, top):
        """Ends the elements from `here` up to, but without, `top`."""
        while here != top:
            ends[here], last[here] = len(tags), len(pieces)
            here = parents[here]
        return top

    for column, value in ((tags, ""), (attrs, {}), (names_of, ()), (parents, -1), (ends, 1), (first, 0), (last, 0)):
        column.append(value)
    here, at, size = 0, 0, len(html)
    tokens = _TOKEN.finditer(html)
    while True:
        token = next(tokens, None)
        start = token.start() if token else size
        if start > at:
            text = html[at:start]
            pieces.append(unescape(text) if "&" in text else text)
        if token is None:
            break
        at = token.end()
        closing, name, rest = token.groups()
        if name is None:
            continue
        tag = name.lower()
        if closing:
            node = here
            while node and tags[node] != tag:
                node = parents[node]
            if node:
                here = rise(here, parents[node])
            continue
        if tag in _CLOSES:
            node = top = here
            while node and tags[node] not in _SCOPE:
                if tags[node] in _CLOSES[tag]:
                    top = parents[node]
                node = parents[node]
            here = rise(here, top)
        given, names = _attributes(rest) if rest else _NO_ATTRIBUTES
        node = len(tags)
        tags.append(tag)
        attrs.append(given)
        names_of.append(names)
        parents.append(here)
        ends.append(node + 1)
        first.append(len(pieces))
        last.append(len(pieces))
        places.setdefault(tag, []).append(node)
        for key in names:
            places.setdefault(key, []).append(node)
        if tag in _RAW:
            stop = _RAW[tag].search(html, at)
            pieces.append(html[at : stop.start() if stop else size])
            last[node] = len(pieces)
            at = stop.end() if stop else size
            tokens = _TOKEN.finditer(html, at)
        elif tag not in _VOID:
            here = node
    rise(here, -1)
    return Node(page, 0)


_NO_ATTRIBUTES = {}, ()


_READ: dict[str, tuple] = {}  # pages of one template write the same attributes


def _attributes(rest):
    """The attributes, and the names by which classes and id are found."""
    if rest in _READ:
        return _READ[rest]
    found = {}
    for name, quoted, single, bare in _ATTRIBUTE.findall(rest):
        value = quoted or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    names = ["." + word for word in found.get("class", "").split()]
    if "id" in found:
        names.append("#" + found["id"])
    if len(_READ) >= 4096:
        _READ.clear()
    return _READ.setdefault(rest, (found, tuple(names)))


def text_at(node: Node, path: str) -> str | None:
    found = node.find(path)
    return found.text() if found is not None else None


def attr_at(node: Node, path: str, name: str) -> str | None:
    found = node.find(path)
    return found.attrs.get(name) if found is not None else None


_COMPILED: dict[str, tuple] = {}  # the readers' few paths


def _compile(path):
    """Per step: the names an element must have, and the parts that attributes must hold."""
    if path not in _COMPILED:
        steps = [_PART.findall(step) for step in path.split()]
        _COMPILED[path] = tuple(
            (tuple(kind + word for kind, word, attr, _, _ in step if not attr), tuple((attr, part) for _, _, attr, _, part in step if attr))
            for step in steps
        )
    return _COMPILED[path]


def _matches(page, i, names, parts):
    for name in names:
        if name not in page.names[i] and name != page.tags[i]:
            return False
    for attr, part in parts:
        value = page.attrs[i].get(attr)
        if value is None or (part and part not in value):
            return False
    return True


def _under(page, i, steps):
    while steps:
        if i < 0:
            return False
        if _matches(page, i, *steps[-1]):
            steps = steps[:-1]
        i = page.parents[i]
    return True
