"""Links of HTML pages with what stands around them: one row per link, in document order."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_ROWS, _CELLS = {"tr", "li", "p", "dd", "dt"}, {"td", "th"}
SCHEMA = "page_url string, ord int, href string, url string, anchor string, row_text string, column_text string, headings array<string>, own_texts array<string>, row_texts array<string>, row_links array<string>, row_index int"


class _Node:
    __slots__ = ("children", "href", "parent", "tag", "texts")

    def __init__(self, tag, parent, href=None):
        self.tag, self.parent, self.href, self.children, self.texts = tag, parent, href, [], []

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.children)

    def up(self, tags):
        node = self
        while node is not None and node.tag not in tags:
            node = node.parent
        return node

    def walk(self):
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(c for c in reversed(node.children) if isinstance(c, _Node))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", None)

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p", "tr", "td", "th", "dd", "dt") and self.at.tag == tag:
            self.at = self.at.parent
        node = _Node(tag, self.at, dict(attrs).get("href"))
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at.up({tag})
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.children.append(data)


def _links(page_url: str, html: str):
    tree = _Tree()
    tree.feed(html or "")
    headings: list[str] = [""] * 7
    owns: list[str] = []
    k = 0
    for node in tree.root.walk():
        if len(node.tag) == 2 and node.tag[0] == "h" and node.tag[1] in "123456":
            level = int(node.tag[1])
            headings[level:] = [node.text()] + [""] * (6 - level)
        own = "".join(c for c in node.children if isinstance(c, str)).strip()
        if own:
            owns.append(own)
        if node.tag != "a" or not node.href:
            continue
        try:
            url = urljoin(page_url, node.href)
        except ValueError:
            continue
        row, cell, tr = node.up(_ROWS), node.up(_CELLS), node.up({"tr"})
        column = ""
        table = cell.up({"table"}) if cell else None
        if table is not None:
            index = [c for c in cell.parent.children if isinstance(c, _Node) and c.tag in _CELLS].index(cell)
            first = next((n for n in table.walk() if n.tag == "tr"), None)
            heads = [c for c in first.children if isinstance(c, _Node) and c.tag in _CELLS] if first else []
            column = heads[index].text() if index < len(heads) else ""
        rows = []
        if tr is not None:
            before = [c for c in tr.parent.children if isinstance(c, _Node) and c.tag == "tr"]
            rows = [r.text() for r in reversed(before[: before.index(tr) + 1])]
        anchors = [n for n in row.walk() if n.tag == "a"] if row else []
        yield (page_url, k, node.href, url, node.text(), (row or node.parent).text(), column, headings[1:], list(owns), rows, [n.href or "" for n in anchors], anchors.index(node) if node in anchors else -1)
        owns = []
        k += 1
    if owns:
        yield (page_url, k, None, None, None, None, None, headings[1:], owns, [], [], -1)


def page_links(pages: DataFrame) -> DataFrame:
    """Links of (page_url, html). own_texts holds the elements' own texts since the link before; a last row without href has those
    after the last link. A page without text has no rows."""

    def scan(frames):
        import pandas as pd

        for frame in frames:
            rows = [r for u, h in zip(frame["page_url"], frame["html"], strict=True) for r in _links(u or "", h)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return pages.select(F.col("page_url").cast("string"), F.col("html").cast("string")).mapInPandas(scan, SCHEMA)
