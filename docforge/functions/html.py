"""Title and text of HTML pages, over Arrow batches, on the standard library's tokenizer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that are no content, and elements that may hold the content, in order.
STRIP = (
    "nav", "footer", "script", "style", "header", "aside", '[role="navigation"]', '[role="banner"]', '[role="contentinfo"]', ".sidebar", ".nav", ".navigation", ".footer",
    ".header", ".menu", ".breadcrumb", ".social", ".share", ".related", ".recommended", ".advertisement", ".ads", "#sidebar", "#nav", "#navigation", "#footer", "#header",
)
MAIN = ("main", "article", '[role="main"]', ".main-content", ".content", ".article", ".post", ".document", "#main", "#content", "#article")
LEAST_MAIN = 50

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_SCOPES = frozenset("table ul ol dl select body div".split())
_SELECTOR = re.compile(r"([a-z0-9]*)(?:\.([\w-]+)|#([\w-]+)|\[(\w+)=\"?([^\"\]]*)\"?\])?")


class Node:
    """An element with its attributes and what it holds: nodes and strings."""

    __slots__ = ("tag", "attrs", "kids", "classes")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.classes = frozenset(attrs.get("class", "").split())

    def walk(self) -> Iterator[Node]:
        """This and all elements below, in document order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [k for k in reversed(node.kids) if isinstance(k, Node)]

    def strings(self) -> list[str]:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                todo += reversed(node.kids)
        return out

    def text(self) -> str:
        return " ".join(" ".join(x.strip() for x in self.strings() if x.strip()).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag)
        if closes:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in closes:
                    del self.open[i:]
                    break
                if self.open[i].tag in _SCOPES:
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def tree(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def matcher(selector: str):
    """A test for ``tag``, ``.class``, ``#id``, ``[attribute="value"]`` or a tag with one of them."""
    m = _SELECTOR.fullmatch(selector.strip())
    if not m or not selector.strip():
        raise ValueError(f"unsupported selector: {selector}")
    tag, cls, ident, attr, value = m.groups()
    return lambda n: (not tag or n.tag == tag) and (not cls or cls in n.classes) and (not ident or n.attrs.get("id") == ident) and (not attr or n.attrs.get(attr) == value)


def find(node: Node, *selectors: str) -> Node | None:
    """The first element in document order that any selector matches."""
    tests = [matcher(s) for s in selectors]
    return next((n for n in node.walk() if n is not node and any(t(n) for t in tests)), None)


def find_all(node: Node, *selectors: str) -> list[Node]:
    tests = [matcher(s) for s in selectors]
    return [n for n in node.walk() if n is not node and any(t(n) for t in tests)]


def strip(node: Node, selectors: tuple[str, ...]) -> None:
    """Remove the elements that a selector matches, with all they hold."""
    tests = [matcher(s) for s in selectors]
    for n in list(node.walk()):
        n.kids = [k for k in n.kids if isinstance(k, str) or not any(t(k) for t in tests)]


def title_of(page: Node, url: str) -> str:
    """title, first h1, og:title, twitter:title, first h2 or h3 with text, last segment of the URL, or Untitled."""
    head = find(page, "title")
    if head is not None and len(head.kids) == 1 and isinstance(head.kids[0], str) and head.kids[0].strip():
        return head.kids[0].strip()
    h1 = find(page, "h1")
    if h1 is not None and h1.text():
        return h1.text()
    for selector in ('meta[property="og:title"]', 'meta[name="twitter:title"]'):
        meta = find(page, selector)
        if meta is not None and meta.attrs.get("content"):
            return meta.attrs["content"].strip()
    for h in find_all(page, "h2", "h3"):
        if h.text():
            return h.text()
    try:
        last = urlparse(url or "").path.strip("/").split("/")[-1]
    except ValueError:
        last = ""
    return last.replace("-", " ").replace("_", " ").title() or "Untitled"


def body_of(page: Node, main: tuple[str, ...] = MAIN) -> str:
    """Text of the first content element with enough of it, else of the body, else of all."""
    for selector in main:
        hit = find(page, selector)
        if hit is not None and len(text := hit.text()) > LEAST_MAIN:
            return text
    body = find(page, "body")
    return (body.text() if body is not None else "") or page.text()


def parse(html: str | None, url: str = "", selectors: tuple[str, ...] = STRIP) -> tuple[str, str]:
    """(title, body text); Untitled and an empty body for blank HTML."""
    if not html or not html.strip():
        return "Untitled", ""
    page = tree(html)
    title = title_of(page, url)
    strip(page, selectors)
    return title, body_of(page)


def parse_pages(df: DataFrame, id_col: str, url_col: str = "url", bytes_col: str = "content_bytes", selectors: tuple[str, ...] = STRIP) -> DataFrame:
    """(id, title, body_text) of pages given as bytes, read as UTF-8 with replacement. Null bytes count as blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [parse((x or b"").decode("utf-8", "replace"), u or "", selectors) for x, u in zip(b.column("c").to_pylist(), b.column("u").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array([t for t, _ in done], pa.string()), pa.array([t for _, t in done], pa.string())], ["k", "title", "body_text"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("k"), F.col(url_col).alias("u"), F.col(bytes_col).alias("c"))
    return picked.mapInArrow(run, f"k {kind}, title string, body_text string").withColumnRenamed("k", id_col)
