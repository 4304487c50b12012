"""Cards: rows that a page repeats, as data.

A card specification says which nodes are rows and what to take from each; one function applies it to payloads and gives
an array of maps of raw strings. What the strings mean is left to column functions, in Spark.

Pages go to Python one by one, a hundred at a time: an Arrow batch has ten thousand rows, which for pages of a hundred
kilobytes are a gigabyte, and a multiple of it as trees and maps.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.sources import dom

#: What to take: text or html of the first node, text of the last, an attribute of the first or last (attr:name,
#: last:name), attributes of all joined by line feeds (all:name), whether there is one (has).
Take = tuple[str, str]


@dataclass(frozen=True)
class Cards:
    rows: str
    fields: Mapping[str, Take]
    #: Fields that are tried in order until one is not empty.
    first_of: Mapping[str, tuple[Take, ...]] = field(default_factory=dict)
    #: Rows of less markup than this don't count; where none counts, the parents of these elements are the rows, one for
    #: each such element, if they have more markup than the last number.
    least_html: int = 0
    parents_of: str = ""
    least_parent: int = 0


def _take(node: dom.Node, selector: str, how: str) -> str | None:
    nodes = node.select(selector) if selector else [node]
    if how == "has":
        return "1" if nodes else None
    if not nodes:
        return None
    kind, _, name = how.partition(":")
    if kind == "text":
        return nodes[0].text()
    if kind == "html":
        return nodes[0].html()
    if kind == "attr":
        return nodes[0].attrs.get(name)
    if kind == "last":
        return nodes[-1].attrs.get(name)
    if kind == "all":
        return "\n".join(x for n in nodes if (x := n.attrs.get(name)))
    raise ValueError(how)


def extract(html: str, cards: Cards) -> list[dict[str, str]]:
    root = dom.parse(html)
    out = _rows(root, cards)
    root.free()
    return out


def _rows(root: dom.Node, cards: Cards) -> list[dict[str, str]]:
    out = []
    nodes = root.select(cards.rows)
    if cards.least_html:
        nodes = [n for n in nodes if len(n.html(True)) > cards.least_html]
    if not nodes and cards.parents_of:
        nodes = [n.parent for n in root.select(cards.parents_of) if len(n.parent.html(True)) > cards.least_parent]
    for node in nodes:
        row = {name: _take(node, *take) for name, take in cards.fields.items()}
        for name, takes in cards.first_of.items():
            row[name] = next((x for take in takes if (x := _take(node, *take)) and x.strip()), None)
        out.append({k: v for k, v in row.items() if v is not None})
    return out


def cards(payload: Column, spec: Cards) -> Column:
    """array<map<string, string>>: a map of the fields that each row has. A null payload has no rows."""

    card_rows = F.udf(lambda html: extract(html, spec) if html else [], "array<map<string,string>>", useArrow=False)
    return card_rows(payload)


@dataclass(frozen=True)
class Sections:
    """Heads and the items that follow them as siblings, in order; `fields` are taken from items."""

    head: str
    item: str
    fields: Mapping[str, Take]


def sections(payload: Column, spec: Sections) -> Column:
    """array<map<string, string>>: one row for each item after a head, with the head's text in `head`."""

    def section_rows(html: str | None) -> list[dict[str, str]]:
        rows, root = [], dom.parse(html or "")
        for head in root.select(spec.head):
            node = head.next()
            while node is not None and node.tag != spec.head:
                if node.tag == spec.item:
                    row = {"head": head.text(), "text": node.text()} | {k: _take(node, *take) for k, take in spec.fields.items()}
                    rows.append({k: v for k, v in row.items() if v is not None})
                node = node.next()
        root.free()
        return rows

    return F.udf(section_rows, "array<map<string,string>>", useArrow=False)(payload)


@dataclass(frozen=True)
class Folds:
    """Ways in which a page folds away named sections, tried in order until one finds any. Each is a kind and selectors:
    `within` (items, their heads, their bodies), `target` (heads that name the id of their body), `rest` (items, the tag
    of their heads; the body is what else an item holds), `next` (heads, bodies that follow them)."""

    root: str
    ways: tuple[tuple[str, ...], ...]
    least: int = 5


def _folded(root: dom.Node, way: tuple[str, ...]) -> list[tuple[str, str]]:
    kind, *how = way
    text = lambda nodes: " ".join("".join(n.text() for n in nodes).split())
    if kind == "within":
        return [((item.select(how[1]) or [dom.Node("", {}, None)])[0].text(), text(item.outermost(how[2]))) for item in root.select(how[0])]
    if kind == "target":
        ids = root.ids()
        named = [(head, head.attrs.get("data-bs-target") or head.attrs.get("href") or "") for head in root.select(how[0])]
        return [(head.text(), text([ids[name[1:]]])) for head, name in named if name.startswith("#") and name[1:] in ids]
    if kind == "rest":
        return [((item.select(how[1]) or [dom.Node("", {}, None)])[0].text(), " ".join(item.text(without=how[1]).split())) for item in root.select(how[0])]
    if kind == "next":
        return [(head.text(), text([body])) for head in root.select(how[0]) if (body := head.next()) is not None and body.is_a(how[1])]
    raise ValueError(kind)


def folded_sections(html: str, spec: Folds) -> dict[str, str]:
    """Lower-case head -> body of a page's folded sections; of equal heads the last one counts."""
    page = dom.parse(html)
    found = _sections(page, spec)
    page.free()
    return found


def _sections(page: dom.Node, spec: Folds) -> dict[str, str]:
    root = next(iter(page.select(spec.root)), None) or next(iter(page.select("body")), page)
    found: dict[str, str] = {}
    for way in spec.ways:
        found = {head.strip().lower(): body for head, body in _folded(root, way) if head.strip() and len(body) > spec.least}
        if found:
            break
    return found


def folds(payload: Column, spec: Folds) -> Column:
    """map<string, string> of a page's folded sections."""

    return F.udf(lambda html: folded_sections(html or "", spec), "map<string,string>", useArrow=False)(payload)


def cards_and_folds(payload: Column, spec: Cards, folded: Folds) -> Column:
    """A struct of cards() and folds(), for which a page is sent to Python and parsed once."""

    def both(html: str | None) -> tuple[list[dict[str, str]], dict[str, str]]:
        page = dom.parse(html or "")
        found = _rows(page, spec) if html else [], _sections(page, folded)
        page.free()
        return found

    return F.udf(both, "cards array<map<string,string>>, folds map<string,string>", useArrow=False)(payload)
