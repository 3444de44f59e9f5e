"""A small element tree for one HTML page, built on one regular expression over its tags.

Attributes and character references are read only where somebody asks for them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = {name: re.compile(f"</{name}", re.I) for name in ("script", "style", "textarea", "title")}
UNREAD = frozenset(("script", "style", "template"))
# An opening tag on the left ends an open element named on the right, up to its container.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
BLOCKS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)


class Element:
    __slots__ = ("_attrs", "children", "parent", "source", "tag")

    def __init__(self, tag: str, source: str, parent: Element | None):
        self.tag, self.source, self.parent = tag, source, parent
        self.children: list[Element | str] = []
        self._attrs: dict[str, str] | None = None

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            for name, double, single, bare in ATTRIBUTE.findall(self.source):
                self._attrs.setdefault(name.lower(), unescape(double or single or bare))
        return self._attrs

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def descendants(self) -> Iterator[Element]:
        stack = [c for c in reversed(self.children) if not isinstance(c, str)]
        while stack:
            element = stack.pop()
            yield element
            stack.extend(c for c in reversed(element.children) if not isinstance(c, str))

    def all(self, tag: str, css: str | None = None, **attrs: str) -> Iterator[Element]:
        """Descendants by tag, class (one class, or the whole attribute) and exact attributes."""
        for element in self.descendants():
            if element.tag != tag:
                continue
            if css is not None and css not in element.classes and css != " ".join(element.classes):
                continue
            if all(element.attrs.get(k) == v for k, v in attrs.items()):
                yield element

    def first(self, tag: str, css: str | None = None, **attrs: str) -> Element | None:
        return next(self.all(tag, css, **attrs), None)

    def next_sibling(self, tag: str) -> Element | None:
        seen = False
        for child in self.parent.children if self.parent else ():
            if seen and not isinstance(child, str) and child.tag == tag:
                return child
            seen = seen or child is self
        return None

    def release(self) -> None:
        """Cut the links between elements below, so that their texts go at once and not with the next search for cycles."""
        stack = [self]
        while stack:
            element = stack.pop()
            stack.extend(c for c in element.children if not isinstance(c, str))
            element.parent, element.children = None, []

    def text(self) -> str:
        """All text pieces, each stripped, joined without a gap."""
        pieces, stack = [], list(reversed(self.children))
        while stack:
            child = stack.pop()
            if isinstance(child, str):
                pieces.append(unescape(child).strip())
            elif child.tag not in UNREAD:
                stack.extend(reversed(child.children))
        return "".join(pieces)


def _close(element: Element, names: frozenset[str], stop: frozenset[str]) -> Element:
    """The element that stays open once open elements of ``names`` below ``stop`` are ended."""
    left = element
    while element.parent is not None and element.tag not in stop:
        if element.tag in names:
            left = element.parent
        element = element.parent
    return left


def parse_html(html: str) -> Element:
    root = current = Element("", "", None)
    position, match = 0, TAG.search(html)
    while match is not None:
        if match.start() > position:
            current.children.append(html[position : match.start()])
        position = match.end()
        name = match["name"]
        if name is not None:
            name = name.lower()
            if match["end"]:
                element = current
                while element.parent is not None and element.tag != name:
                    element = element.parent
                if element.parent is not None:
                    current = element.parent
            else:
                if name in ENDS:
                    current = _close(current, *ENDS[name])
                elif name in BLOCKS and current.tag == "p":
                    current = current.parent
                element = Element(name, match["attrs"], current)
                current.children.append(element)
                if name in RAW:
                    found = RAW[name].search(html, position)
                    stop = found.start() if found else len(html)
                    element.children.append(html[position:stop])
                    position = stop
                if name not in VOID:
                    current = element
        match = TAG.search(html, position)
    if position < len(html):
        current.children.append(html[position:])
    return root
