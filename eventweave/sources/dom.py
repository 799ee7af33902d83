"""A small element tree on the standard library's HTML parser, with the implied end tags that lists and tables rely on.

Plain pages (lower-case tags, attributes in double quotes, no comments, scripts or
character references in attributes) are cut into tags without that parser, which
takes most of the time; any other page goes through it whole. The tree is the same.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import escape, unescape
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An opening tag ends an open one of these, unless one of the barriers stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "p": ({"p"}, set()), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
BLOCKS = {"ul", "ol", "div", "table", "dl", "h1", "h2", "h3", "h4"}
#: For each opening tag that ends others: what it ends, and the barriers.
ENDS = CLOSES | {t: ({"p"}, {"li", "td", "th"}) for t in BLOCKS}
#: Elements whose content is not markup, in any version of the standard library's parser.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
TAG = re.compile(r'<(/?)([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*="[^"<>&]*")*)>([^<]*)')
ATTRIBUTE = re.compile(r' ([a-z][a-z0-9-]*)="([^"]*)"')


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    attrs: dict = field(default_factory=dict)
    children: list = field(default_factory=list)
    parent: Node | None = None
    kept: str | None = None

    def classes(self) -> set[str]:
        c = self.attrs.get("class")
        return set(c.split()) if c else set()

    def walk(self):
        """This element and all below, in document order."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, tag: str | None = None, cls: str | None = None, ident: str | None = None) -> Node | None:
        return next(self.find_all(tag, cls, ident), None)

    def find_all(self, tag: str | None = None, cls: str | None = None, ident: str | None = None):
        stack = [c for c in reversed(self.children) if c.__class__ is not str]
        while stack:
            n = stack.pop()
            stack += [c for c in reversed(n.children) if c.__class__ is not str]
            if (tag is None or n.tag == tag) and (cls is None or cls in n.attrs.get("class", "") and cls in n.classes()) and (ident is None or n.attrs.get("id") == ident):
                yield n

    def text(self, skip: frozenset = frozenset()) -> str:
        return "".join(c if isinstance(c, str) else "" if c.tag in skip else c.text(skip) for c in self.children)

    def has_text(self) -> bool:
        """Is there more than white space?"""
        return any(isinstance(c, str) and not c.isspace() and c != "" or isinstance(c, Node) and c.has_text() for c in self.children)

    def following(self):
        """Elements after this one under the same parent."""
        if self.parent is None:
            return
        after = False
        for c in self.parent.children:
            if after and isinstance(c, Node):
                yield c
            after = after or c is self

    def html(self) -> str:
        if self.kept is not None:
            return self.kept
        attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in self.attrs.items())
        if self.tag in VOID:
            return f"<{self.tag}{attrs}>"
        inside = "".join(escape(c, quote=False) if isinstance(c, str) else c.html() for c in self.children)
        out = f"<{self.tag}{attrs}>{inside}</{self.tag}>"
        if self.tag == "li":  # nested items are asked for one by one
            self.kept = out
        return out


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.ids: dict[str, Node] = {}

    def handle_starttag(self, tag, attrs):
        ends, barriers = ENDS.get(tag, (set(), set()))
        n = self.at
        while ends and n is not self.root and n.tag not in barriers:
            if n.tag in ends:
                self.at = n.parent
            n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, parent=self.at)
        self.at.children.append(node)
        if "id" in node.attrs:
            self.ids.setdefault(node.attrs["id"], node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        n = self.at
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _plain(html: str) -> tuple[Node, dict[str, Node]] | None:
    """As the builder makes them of a plain page; None for any other."""
    first, tags = html.partition("<")[0], TAG.findall(html)
    if len(first) + sum([2 + len(a) + len(b) + len(c) + len(d) for a, b, c, d in tags]) != len(html):
        return None
    root = at = Node("#root")
    ids: dict[str, Node] = {}
    if first:
        at.children.append(unescape(first))
    # where all tags are closed in order, and nothing is written another way than in html(), an item's html is a piece of the page
    as_written = "&" not in html and "'" not in html and ">" not in first
    spans: list[tuple[Node, int, int]] = []
    starts: list[int] = []
    i = len(first)
    for slash, name, rest, text in tags:
        begin, i = i, i + 2 + len(slash) + len(name) + len(rest) + len(text)
        if slash:
            if rest:
                return None
            if at.tag == name and at is not root:
                if starts:
                    start = starts.pop()
                    if name == "li":
                        spans.append((at, start, i - len(text)))
                at = at.parent
            else:
                as_written = False
                n = at
                while n is not root and n.tag != name:
                    n = n.parent
                if n is not root:
                    at = n.parent
        else:
            if name in RAW:
                return None
            if name in ENDS:
                ends, barriers = ENDS[name]
                n = at
                while n is not root and n.tag not in barriers:
                    if n.tag in ends:
                        at, as_written = n.parent, False
                    n = n.parent
            if rest:
                pairs = ATTRIBUTE.findall(rest)
                attrs = dict(pairs)
                as_written = as_written and len(attrs) == len(pairs)
                node = Node(name, attrs, [], at)
                if "id" in attrs:
                    ids.setdefault(attrs["id"], node)
            else:
                node = Node(name, {}, [], at)
            at.children.append(node)
            if name not in VOID:
                at = node
                starts.append(begin)
        if text:
            if "&" in text:
                text = unescape(text)
            elif ">" in text:
                as_written = False
            at.children.append(text)
    if as_written:
        for node, start, end in spans:
            node.kept = html[start:end]
    return root, ids


def parse_with_ids(html: str) -> tuple[Node, dict[str, Node]]:
    """The tree, and the first element of each id."""
    if html and (made := _plain(html)) is not None:
        return made
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root, b.ids


def parse(html: str) -> Node:
    return parse_with_ids(html)[0]
