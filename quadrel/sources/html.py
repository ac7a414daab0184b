"""HTML pages as rows: links, headings, readable text, tables.

Pages are parsed with the standard library's tolerant parser in Arrow batches; what is
taken from them afterwards is built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from quadrel.functions.slug import cell_bool, cell_number, collapsed, files_route, header_text, parse_created

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNREAD = ("script", "style", "noscript")
TEXT_LIMIT = 30_000
STEPS_LIMIT = 4_000
STEPS_LEAST = 120
TITLE_LIMIT = 1_800


class Node:
    """An element: name, attributes, children (elements and strings), parent."""

    def __init__(self, name: str, attributes: dict[str, str], parent: Node | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def find(self, name: str, classes: tuple[str, ...] = ()) -> Node | None:
        for n in self.walk():
            if n is not self and n.name == name and set(classes) <= set(n.attributes.get("class", "").split()):
                return n
        return None

    def unlink(self) -> None:
        """Take the ways up out of the tree, so that it goes with its last use and waits for no collection of cycles."""
        for n in self.walk():
            n.parent = None

    def text(self, separator: str = " ") -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.name not in UNREAD:
                stack += reversed(node.children)
        return " ".join(separator.join(out).split())


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.root


def read(html: str | None, then):
    """``then`` of a page's tree, which goes before the next page is read."""
    root = tree(html)
    try:
        return then(root)
    finally:
        root.unlink()


def _column(then, schema: DataType):
    @F.pandas_udf(schema)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda html: read(html, then))

    return run


def _links(root: Node) -> list[tuple]:
    out = []
    for n in root.walk():
        if n.name == "a" and "href" in n.attributes:
            up, inside = n.parent, ""
            while up is not None and not inside:
                inside = " ".join(filter(None, (up.name, up.attributes.get("class", "")))) if up.name in ("section", "nav", "main", "article") else ""
                up = up.parent
            out.append((inside, n.text(), n.attributes.get("title") or n.attributes.get("data-title") or n.attributes.get("aria-label"), n.attributes["href"]))
    return out


def _readable(root: Node) -> str:
    for found in (root.find("main"), root.find("div", ("model-detail",)), root.find("body"), root):
        if found is not None:
            return found.text()[:TEXT_LIMIT]
    return ""


def _steps(root: Node) -> str | None:
    for n in root.walk():
        if n.name in ("h1", "h2", "h3", "h4", "h5", "h6") and "step" in n.text().lower():
            up = n.parent
            while up is not None:
                if len(text := up.text()) >= STEPS_LEAST:
                    return text[:STEPS_LIMIT]
                up = up.parent
    return None


def _table(root: Node) -> list[dict]:
    table = root.find("table")
    if table is None:
        return []
    rows = [[c for c in r.children if isinstance(c, Node) and c.name in ("td", "th")] for r in table.walk() if r.name == "tr"]
    rows = [r for r in rows if r]
    if not rows:
        return []
    heads = [c.text() for c in rows[0]]
    out = []
    for i, row in enumerate(rows[1:]):
        cells = []
        for head, cell in zip(heads, row, strict=False):
            inner = next((n.attributes["title"] for n in cell.walk() if n.attributes.get("title")), None)
            link = next((n.attributes["href"] for n in cell.walk() if n.name == "a" and "href" in n.attributes), None)
            cells.append((head, cell.text(), cell.attributes.get("data-sort-value"), cell.attributes.get("style", ""), inner, link))
        out.append((i, cells))
    return out


def _task(root: Node) -> tuple:
    title = root.find("h1")
    return (title.text() if title else None, [n.text() for n in root.walk() if n.name == "p"])


def _rows(**fields: DataType) -> StructType:
    return StructType([StructField(k, t) for k, t in fields.items()])


_S = StringType()
links_of = _column(_links, ArrayType(_rows(section=_S, text=_S, title=_S, href=_S)))
readable_text = _column(_readable, _S)
steps_text = _column(_steps, _S)
table_rows = _column(_table, ArrayType(_rows(row=IntegerType(), cells=ArrayType(_rows(head=_S, text=_S, sort=_S, style=_S, title=_S, href=_S)))))
task_parts = _column(lambda root: [_task(root)], ArrayType(_rows(title=_S, paragraphs=ArrayType(_S))))


def absolute(base: Column, href: Column) -> Column:
    """A link made absolute, without its fragment."""
    host = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<![/:])/[^/]*$", "/")
    whole = (
        F.when(href.rlike(r"^[A-Za-z][\w+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][\w+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(host, href))
        .otherwise(F.concat(folder, href))
    )
    return F.regexp_replace(whole, "#.*$", "")


def link_set(pages: DataFrame, html: str, url: str, prefix: str) -> DataFrame:
    """(link) of all pages whose href begins with ``prefix``: absolute, each once, in order."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    found = pages.select(F.col(url).alias("base"), F.explode(hrefs).alias("href")).where(F.col("href").startswith(prefix))
    return found.select(absolute(F.col("base"), F.col("href")).alias("link")).distinct().orderBy("link")


def file_links(url: Column, listing: Column, html_: Column) -> Column:
    """array<string> of the YAML files behind a URL: itself, those of a repository folder's listing (JSON), or those that a page links to, absolute, each once."""
    entries = F.from_json(listing, "array<struct<name string, download_url string>>")
    listed = F.transform(F.filter(entries, lambda e: e["name"].rlike(r"\.ya?ml$") & e["download_url"].isNotNull()), lambda e: e["download_url"])
    hrefs = F.regexp_extract_all(html_, F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))
    linked = F.array_distinct(F.transform(F.filter(hrefs, lambda h: h.rlike(r"\.ya?ml$")), lambda h: absolute(url, h)))
    route = files_route(url)
    found = F.when(route == "file", F.array(url)).when(route == "api", listed).when(route == "page", linked)
    return F.coalesce(found, F.array().cast("array<string>"))


def numbered_slice(links: DataFrame, start: int = 1, limit: int | None = None) -> DataFrame:
    """Links from number ``start`` (from one, by order) on, ``limit`` of them."""
    out = links.orderBy("link").offset(start - 1)
    return out.limit(limit) if limit is not None else out


def section_link(links: Column, kind: str) -> Column:
    """The first link of the links section whose text or tooltip names ``kind``."""
    fits = F.filter(links, lambda x: x["section"].contains("links") & (F.lower(F.concat_ws(" ", x["text"], x["title"])).contains(kind)))
    return F.get(fits, F.lit(0))["href"]


def title_of(html: Column) -> Column:
    """Text of the first h1, tags taken out."""
    inner = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return collapsed(F.regexp_replace(inner, "<[^>]*>", " "))


def task_context(pages: DataFrame, html: str, limit: int = TITLE_LIMIT) -> DataFrame:
    """The columns and (title, context): paragraphs until their running length passes ``limit``; the one that does is kept."""
    whole = pages.withColumn("_t", F.element_at(task_parts(F.col(html)), 1))
    state = F.aggregate(
        F.filter("_t.paragraphs", lambda p: p != ""),
        F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("size")),
        lambda a, p: F.when(a["size"] > limit, a).otherwise(F.struct(F.array_append(a["kept"], p).alias("kept"), (a["size"] + F.length(p)).alias("size"))),
        lambda a: F.array_join(a["kept"], "\n"),
    )
    return whole.select(*pages.columns, F.col("_t.title").alias("title"), state.alias("context"))


def dataset_rows(pages: DataFrame, html: str) -> DataFrame:
    """One row for each row of a page's first table: (row, cells map<head, struct>), heads without arrows."""
    rows = pages.select(*[c for c in pages.columns if c != html], F.explode(table_rows(F.col(html))).alias("r"))
    named = F.map_from_entries(F.transform("r.cells", lambda c: F.struct(F.lower(header_text(c["head"])).alias("key"), c.alias("value"))))
    return rows.select(*[c for c in rows.columns if c != "r"], F.col("r.row").alias("row"), named.alias("cells"))


def typed_cell(cells: Column, head: str, kind: str = "text") -> Column:
    """A table cell as ``text``, ``number``, ``bool``, ``date`` or ``href``."""
    cell = F.element_at(cells, head)
    return {"text": collapsed(cell["text"]), "number": cell_number(cell["sort"], cell["text"]), "bool": cell_bool(cell["style"]), "date": parse_created(cell["title"], cell["text"]), "href": cell["href"]}[kind]
