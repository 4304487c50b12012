"""A small HTML tree on the standard library's tokenizer, with the selectors that card extraction needs: tag, .class,
#id, [attr], [attr='v'], [attr*='v'], [attr^='v'], [attr$='v'], descendants and comma lists."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Tags that end an open one of these when they begin.
CLOSES = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
BLOCKS = frozenset("div ul ol table section article header footer h1 h2 h3 h4 h5 h6 form blockquote hr pre main aside nav".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "elements", "order")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        #: Children that are elements, and the place among those of its parent.
        self.elements: list[Node] = []
        self.order = 0

    def add(self, node: Node) -> Node:
        node.order = len(self.elements)
        self.elements.append(node)
        self.children.append(node)
        return node

    def walk(self) -> Iterator[Node]:
        stack = self.elements[::-1]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.elements))

    def free(self) -> None:
        """Take the tree apart: nodes and their parents refer to each other, so a tree that is done with would stay until
        the collector of cycles gets to it, with many others."""
        for node in (*self.walk(), self):
            node.parent, node.children, node.elements = None, [], []

    def text(self, without: str | None = None) -> str:
        """All text within, without that of elements of one tag."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag != without:
                stack.extend(reversed(x.children))
        return "".join(out)

    def html(self, outer: bool = False) -> str:
        inner = "".join(c if isinstance(c, str) else c.html(True) for c in self.children)
        if not outer:
            return inner
        attrs = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>" + ("" if self.tag in VOID else f"{inner}</{self.tag}>")

    def select(self, selector: str) -> list[Node]:
        choices = _compiled(selector)
        return [n for n in self.walk() if any(_matches(n, steps) for steps in choices)]

    def outermost(self, selector: str) -> list[Node]:
        """Selected elements that are not within another one of them."""
        choices, out, stack = _compiled(selector), [], self.elements[::-1]
        while stack:
            node = stack.pop()
            if any(_matches(node, steps) for steps in choices):
                out.append(node)
            else:
                stack.extend(reversed(node.elements))
        return out

    def is_a(self, selector: str) -> bool:
        return any(_matches(self, steps) for steps in _compiled(selector))

    def next(self) -> Node | None:
        own = self.parent.elements if self.parent else []
        return own[self.order + 1] if self.order + 1 < len(own) else None

    def ids(self) -> dict[str, Node]:
        """The first element of each id."""
        out: dict[str, Node] = {}
        for node in self.walk():
            if name := node.attrs.get("id"):
                out.setdefault(name, node)
        return out


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.open = [self.root]

    def _end(self, *tags: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in ("table", "ul", "ol", "div", "section", "article", "body"):
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES:
            self._end(*CLOSES[tag])
        elif tag in BLOCKS:
            self._end("p")
        node = self.open[-1].add(Node(tag, {k: v or "" for k, v in attrs}, self.open[-1]))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].add(Node(tag, {k: v or "" for k, v in attrs}, self.open[-1]))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


_STEP = re.compile(r"""([a-zA-Z][\w-]*|\*)|\.([\w-]+)|\#([\w-]+)|\[([\w:-]+)(?:([*^$]?)=['"]?([^'"\]]*)['"]?)?\]""")
_cache: dict[str, list] = {}


def _compiled(selector: str) -> list[list[list[tuple]]]:
    if selector not in _cache:
        _cache[selector] = [[[m.groups() for m in _STEP.finditer(step)] for step in re.findall(r"(?:\[[^\]]*\]|\S)+", one.strip())] for one in re.findall(r"(?:\[[^\]]*\]|[^,])+", selector)]
    return _cache[selector]


def _fits(node: Node, tests: list[tuple]) -> bool:
    for tag, cls, ident, attr, how, value in tests:
        if tag:
            ok = tag == "*" or node.tag == tag
        elif cls:
            ok = cls in node.attrs.get("class", "").split()
        elif ident:
            ok = node.attrs.get("id") == ident
        else:
            own = node.attrs.get(attr)
            ok = own is not None and (value is None or (how == "*" and value in own) or (how == "^" and own.startswith(value)) or (how == "$" and own.endswith(value)) or (not how and own == value))
        if not ok:
            return False
    return True


def _matches(node: Node, steps: list[list[tuple]]) -> bool:
    if not _fits(node, steps[-1]):
        return False
    above = node.parent
    for step in reversed(steps[:-1]):
        while above is not None and not (above.tag and _fits(above, step)):
            above = above.parent
        if above is None:
            return False
        above = above.parent
    return True
