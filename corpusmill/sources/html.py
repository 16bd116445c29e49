"""Title and description rows from fetched HTML pages: headings, definition lists and tables.

Pages come as a table of HTML; fetching them is not part of the engine. Defined results: null and empty pages give no row; broken
markup is read as far as it goes; repeated headings give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import map_columns

NOT_FOUND = "N/A"
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {"p": {"p", "div", "h1", "h2", "h3", "ul", "ol", "table", "dl"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}


@dataclass
class Node:
    tag: str
    parent: Node | None = None
    children: list = field(default_factory=list)
    attributes: dict = field(default_factory=dict)

    def text(self, strip_parts: bool = False) -> str:
        parts = [c if isinstance(c, str) else c.text(strip_parts) for c in self.children]
        return "".join(p.strip() for p in parts) if strip_parts else "".join(parts)

    def find(self, *path: str) -> Node | None:
        """The first element in document order that ends the descendant path."""
        if not path:
            return self
        for n in self.walk():
            if n.tag == path[0] and (hit := n.find(*path[1:])) is not None:
                return hit
        return None

    def walk(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.walk()


_STEP = re.compile(r"\s*(>)?\s*([a-zA-Z][\w-]*)?((?:[#.][\w-]+|:nth-child\(\d+\))*)")


def _matches(node: Node, tag: str | None, marks: str) -> bool:
    if tag and node.tag != tag.lower():
        return False
    for mark, name, n in re.findall(r"([#.])([\w-]+)|:nth-child\((\d+)\)", marks):
        if n:
            siblings = [c for c in node.parent.children if isinstance(c, Node)]
            if len(siblings) < int(n) or siblings[int(n) - 1] is not node:
                return False
        elif mark == "#" and node.attributes.get("id") != name or mark == "." and name not in (node.attributes.get("class") or "").split():
            return False
    return True


def select(root: Node, selector: str) -> list[Node]:
    """Elements that a path of tags, ids, classes and ``:nth-child`` names, with ``>`` for children and a space for descendants."""
    found, at = [root], 0
    selector = selector.strip()
    while at < len(selector):
        m = _STEP.match(selector, at)
        if not (m[2] or m[3]):
            raise ValueError(f"selector: {selector[at:]}")
        steps = ((c for c in n.children if isinstance(c, Node)) if m[1] else n.walk() for n in found)
        found = list({id(x): x for step in steps for x in step if _matches(x, m[2], m[3])}.values())
        at = m.end()
    return found


def _rows(html: str, within: str | None):
    root = tree(html)
    seen: set[int] = set()
    for part in select(root, within) if within else [root]:
        for n in part.walk():
            if n.tag == "tr" and id(n) not in seen:
                seen.add(id(n))
                yield n


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        while self.at.tag in _CLOSED_BY and tag in _CLOSED_BY[self.at.tag]:
            self.at = self.at.parent
        node = Node(tag, self.at, attributes=dict(attrs))
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, self.at, attributes=dict(attrs)))

    def handle_endtag(self, tag):
        at = self.at
        while at is not None and at.tag != tag:
            at = at.parent
        if at is not None and at.parent is not None:
            self.at = at.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def headings(html: str, tags: tuple[str, ...] = ("h2",), word: str = "error") -> list[tuple[str, str]]:
    """Headings that hold the word in any case, each with the next paragraph in document order."""
    nodes = list(tree(html).walk())
    paragraphs = [(i, n) for i, n in enumerate(nodes) if n.tag == "p"]
    out, k = [], 0
    for i, n in enumerate(nodes):
        if n.tag in tags:
            while k < len(paragraphs) and paragraphs[k][0] <= i:
                k += 1
            title = n.text(True)
            if word in title.lower():
                out.append((title, paragraphs[k][1].text(True) if k < len(paragraphs) else ""))
    return out


def definitions(html: str, words: tuple[str, ...] = ("Error", "Exception")) -> list[tuple[str, str]]:
    """Terms of definition lists that hold one of the words, each with the next ``dd`` beside it."""
    out = []
    for n in tree(html).walk():
        if n.tag == "dt" and any(w in (title := n.text().strip()) for w in words):
            siblings = [c for c in n.parent.children if isinstance(c, Node)]
            after = siblings[next(i for i, c in enumerate(siblings) if c is n) + 1 :]
            described = next((c for c in after if c.tag == "dd"), None)
            out.append((title, described.text().strip() if described else ""))
    return out


def header_table(html: str, within: str | None = None) -> list[tuple[str, str]]:
    """Rows, of the tables that ``within`` selects or of all, with a code name in a header cell and a span in a data cell; both must be there."""
    out = []
    for row in _rows(html, within):
        name = row.find("th", "a", "code", "span") or row.find("th", "code", "span")
        described = row.find("td", "span")
        if name and described:
            out.append((name.text().strip(), described.text().strip()))
    return out


def cell_table(html: str, within: str | None = None) -> list[tuple[str, str]]:
    """First two data cells of the rows of the tables that ``within`` selects, or of all; one of them is enough, a missing one is ``N/A``."""
    out = []
    for row in _rows(html, within):
        cells = [c for c in row.children if isinstance(c, Node) and c.tag == "td"]
        if cells:
            out.append((cells[0].text().strip(), cells[1].text().strip() if len(cells) > 1 else NOT_FOUND))
    return out


def extract(pages: DataFrame, how: Callable[[str], list[tuple[str, str]]], source: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, idx, title, description, source) of each page; map-only."""

    def batch(keys, texts):
        out = {"k": [], "idx": [], "title": [], "description": []}
        for k, t in zip(keys, texts):
            for i, (title, described) in enumerate(how(t) if t else ()):
                for name, v in zip(out, (k, i, title, described)):
                    out[name].append(v)
        return out

    rows = map_columns(pages.where(F.col(html).isNotNull()), [key, html], batch, "k bigint, idx int, title string, description string")
    return rows.select(F.col("k").alias(key), "idx", "title", "description", F.lit(source).alias("source"))
