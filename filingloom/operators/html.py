"""Stored pages to nested records. One pass over each page in Arrow batches; only the kinds asked for are made.

Tags nest as they are written: an end tag closes up to its own start, an unmatched one is ignored, nothing closes by
itself. Text is what the fragments say with blanks stripped at both ends of each, joined without separator.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_DROPPED = {"script", "style", "noscript", "iframe", "svg"}
#: Tags whose content isn't read as markup.
_RAW = {"script", "style", "noscript", "iframe", "svg", "textarea", "xmp", "noembed", "noframes", "plaintext", "math"}
_SIMPLE = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?: +[a-zA-Z][a-zA-Z:_-]*="[^"<>&]*")*) *(/?)>([^<]*)')
_ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z:_-]*)="([^"]*)"')
#: Pages that are made into records at once.
SLICE = 100

KINDS = {
    "title": "string",
    "metadata": "map<string,string>",
    "content": "struct<paragraphs:array<string>,full_text:string,word_count:int>",
    "headings": "array<struct<level:int,text:string>>",
    "links": "array<struct<category:string,url:string,href:string,text:string,title:string>>",
    "documents": "array<struct<url:string,text:string,type:string>>",
    "images": "array<struct<url:string,alt:string,title:string>>",
    "index": "array<struct<symbol:string,company:string,url:string>>",
    "tables": "array<struct<headers:array<array<string>>,body:array<array<string>>,footer:array<array<string>>,links:array<struct<url:string,text:string,title:string,is_company_profile:boolean>>,row_count:int,column_count:int>>",
}


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """All nodes below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def first(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, Node):
                stack += reversed(n.children)
            elif s := n.strip():
                yield s

    def text(self, between: str = "") -> str:
        return between.join(self.strings())

    def above(self, *tags: str) -> bool:
        n = self.parent
        while n is not None:
            if n.tag in tags:
                return True
            n = n.parent
        return False


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in _DROPPED:
            self.skip += 1
        elif not self.skip:
            node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
            self.at.children.append(node)
            if tag not in _VOID:
                self.at = node

    def handle_startendtag(self, tag, attrs):
        if tag not in _DROPPED and not self.skip:
            self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        if tag in _DROPPED:
            self.skip = max(0, self.skip - 1)
            return
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None and not self.skip:
            self.at = n.parent

    def handle_data(self, data):
        if not self.skip:
            self.at.children.append(data)


def simple(html: str) -> Node | None:
    """The tree of a page that has only plain tags and text, or None: what `_Builder` makes of it, in less time."""
    if html[:1] != "<" or html[-1:] != ">":
        return None
    b, done, titled = _Builder(), 0, False
    for m in _SIMPLE.finditer(html):
        end, tag, attrs, closed, text = m.groups()
        tag = tag.lower()
        if m.start() != done or tag in _RAW or titled and not (end and tag == "title") or end and (attrs or closed):
            return None
        done, titled = m.end(), tag == "title" and not end
        if end:
            b.handle_endtag(tag)
        elif closed:
            if titled:
                return None
            b.handle_startendtag(tag, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attrs)])
        else:
            b.handle_starttag(tag, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else ())
        if text:
            b.handle_data(unescape(text) if "&" in text else text)
    return b.root if done == len(html) and not titled else None


def tree(html: str | None) -> Node:
    if html and (made := simple(html)) is not None:
        return made
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _join(base: str, href: str) -> str:
    try:
        return urljoin(base, href)
    except ValueError:
        return href


def _netloc(url: str) -> str:
    try:
        return urlsplit(url).netloc
    except ValueError:
        return ""


def title(root: Node) -> str:
    n = root.first("title")
    if n is not None and len(n.children) == 1 and isinstance(n.children[0], str) and n.children[0]:
        return n.children[0].strip()
    for m in root.all("meta"):
        if m.attrs.get("property") == "og:title" and m.attrs.get("content"):
            return m.attrs["content"].strip()
    n = root.first("h1")
    return n.text() if n is not None else ""


def metadata(root: Node) -> dict[str, str]:
    found = {}
    for m in root.all("meta"):
        name = m.attrs.get("name") or m.attrs.get("property")
        if name and m.attrs.get("content"):
            found[name] = m.attrs["content"]
    return {k: v for k, v in found.items() if k in R.METADATA_KEYS}


def content(root: Node) -> dict:
    tests = (lambda n: n.tag == "main", lambda n: n.tag == "article", lambda n: n.attrs.get("role") == "main", lambda n: n.attrs.get("id") == "content", lambda n: "content" in n.attrs.get("class", "").split(), lambda n: n.tag == "body")
    part = next((n for test in tests for n in root.walk() if test(n)), root)
    paragraphs = [t for n in part.all("p", "div") if len(t := n.text()) > 20]
    full = re.sub(r"\n{3,}", "\n\n", part.text("\n"))
    return {"paragraphs": paragraphs[:50], "full_text": full, "word_count": len(full.split())}


def headings(root: Node) -> list[dict]:
    return [{"level": k, "text": t} for k in range(1, 7) for n in root.all(f"h{k}") if (t := n.text())]


def _anchors(root: Node, base: str):
    for n in root.all("a"):
        if "href" in n.attrs:
            href = n.attrs["href"].strip()
            if href and not href.startswith(("#", "javascript:")):
                yield n, href, _join(base, href)


def links(root: Node, base: str) -> list[dict]:
    own, out = _netloc(base), []
    for n, href, url in _anchors(root, base):
        at = _netloc(url)
        marked = n.above("nav", "header", "footer") or any(k in n.attrs.get("class", "").lower() for k in R.NAVIGATION_CLASSES)
        category = "navigation" if marked else "internal" if own and at == own else "external" if at else None
        if category:
            out.append({"category": category, "url": url, "href": href, "text": n.text(), "title": n.attrs.get("title", "")})
    order = {"internal": 0, "external": 1, "navigation": 2}
    return sorted(out, key=lambda x: order[x["category"]])


def documents(root: Node, base: str) -> list[dict]:
    found = ((n, n.attrs["href"].strip()) for n in root.all("a") if "href" in n.attrs)
    return [{"url": _join(base, h), "text": n.text(), "type": h.rsplit(".", 1)[-1].upper()} for n, h in found if h.lower().endswith(tuple(R.LINKED_EXTENSIONS))]


def images(root: Node, base: str) -> list[dict]:
    return [{"url": _join(base, n.attrs["src"].strip()), "alt": n.attrs.get("alt", ""), "title": n.attrs.get("title", "")} for n in root.all("img") if "src" in n.attrs][:20]


def _cells(row: Node) -> list[str]:
    return [c.text() for c in row.all("td", "th")]


def _rows(part: Node | None) -> list[list[str]]:
    return [c for r in part.all("tr") if (c := _cells(r))] if part is not None else []


def _body(t: Node) -> tuple[list, list[Node]]:
    """Cells of a table's header rows, and its other rows."""
    head, body = t.first("thead"), t.first("tbody")
    headers = _rows(head)
    if head is None:
        for r in t.all("tr")[:3]:
            if r.first("th") is None:
                break
            headers.append(_cells(r))
    if body is not None:
        return headers, [r for r in body.all("tr") if _cells(r)]
    own = [r for r in t.children if isinstance(r, Node) and r.tag == "tr"]
    return headers, [r for r in own if not (r.first("th") is not None and r.first("td") is None) and (c := _cells(r)) and c not in headers]


def table(t: Node, base: str) -> dict:
    headers, rows = _body(t)
    found = [{"url": u, "text": n.text(), "title": n.attrs.get("title", ""), "is_company_profile": "/quotes/" in u.lower() or "symbol" in u.lower()} for r in rows for n, _, u in _anchors(r, base)]
    cells = [_cells(r) for r in rows]
    return {"headers": headers, "body": cells, "footer": _rows(t.first("tfoot")), "links": found, "row_count": len(cells), "column_count": len((headers or cells or [[]])[0])}


def index(t: Node, base: str) -> list[dict]:
    """For each link of a row of at least two cells, below the header row: the first two cells as symbol and company."""
    rows = [r for r in t.all("tr")[1:] if len(_cells(r)) > 1]
    return [{"symbol": c[0].strip(), "company": c[1].strip(), "url": u} for r in rows for c in [_cells(r)] for _, _, u in _anchors(r, base)]


def page(html: str | None, url: str | None, kinds: tuple[str, ...]) -> dict:
    root, base = tree(html), url or ""
    made = {
        "title": lambda: title(root), "metadata": lambda: metadata(root), "content": lambda: content(root), "headings": lambda: headings(root), "links": lambda: links(root, base), "documents": lambda: documents(root, base),
        "images": lambda: images(root, base), "tables": lambda: [table(t, base) for t in root.all("table")[:5]],
        "index": lambda: [x for t in root.all("table") for x in index(t, base)],
    }
    return {k: made[k]() for k in kinds}


def parsed(pages: DataFrame, *kinds: str) -> DataFrame:
    """pages (url, html and others) without html, with the kinds of records asked for (all of KINDS without names)."""
    kinds = kinds or tuple(KINDS)
    kept = pages.drop(*kinds)
    types = T.StructType.fromDDL(", ".join(f"{k} {KINDS[k]}" for k in kinds))
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(f.dataType) for f in types]

    def run(batches):
        for b in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            got = [page(h, u, kinds) for h, u in zip(b.column("html").to_pylist(), b.column("url").to_pylist(), strict=True)]
            cols = {k: pa.array([list(r[k].items()) if k == "metadata" else r[k] for r in got], t) for k, t in zip(kinds, arrow, strict=True)}
            yield pa.record_batch({n: b.column(n) for n in b.schema.names if n != "html"} | cols)

    return kept.mapInArrow(run, T.StructType([*(f for f in kept.schema if f.name != "html"), *types]))


def rendered(pages: DataFrame) -> DataFrame:
    """pages (html and others) with text: what the whole page says, a line for each run of text."""

    def run(batches):
        for b in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            texts = [None if h is None else re.sub(r"\n{3,}", "\n\n", tree(h).text("\n")) for h in b.column("html").to_pylist()]
            yield pa.record_batch({n: b.column(n) for n in b.schema.names} | {"text": pa.array(texts, pa.string())})

    given = pages.drop("text")
    return given.mapInArrow(run, T.StructType([*given.schema, T.StructField("text", T.StringType())]))


def only_references(html: Column, *names: str) -> Column:
    """A page in which the named references alone (`lt` for `&lt;`) stand for characters; any other, and one cut short, is
    text as it is written."""
    return F.regexp_replace(html, f"&(?!(?:{'|'.join(names)});)", "&amp;")


def exploded(df: DataFrame, kind: str, *keys: str) -> DataFrame:
    """A row for each record of a kind, with its position."""
    out = df.select(*keys, F.posexplode(kind).alias("ord", "_r"))
    return out.select(*keys, "ord", "_r.*") if isinstance(out.schema["_r"].dataType, T.StructType) else out.withColumnRenamed("_r", "text")


def content_summary(df: DataFrame) -> DataFrame:
    """Counts and flags of what pages hold, from links, documents, tables, headings and content."""

    def of(category):
        return F.size(F.filter("links", lambda x: x["category"] == category))

    counts = {"table_count": F.size("tables"), "document_count": F.size("documents"), "internal_link_count": of("internal"), "external_link_count": of("external"), "navigation_link_count": of("navigation"), "heading_count": F.size("headings"), "word_count": F.col("content.word_count")}
    flags = {"has_tables": counts["table_count"] > 0, "has_documents": counts["document_count"] > 0, "has_internal_links": counts["internal_link_count"] > 0, "has_external_links": counts["external_link_count"] > 0, "has_navigation_links": counts["navigation_link_count"] > 0}
    return df.withColumns({**counts, **flags, "document_types": F.array_sort(F.array_distinct(F.transform("documents", lambda d: d["type"])))})


def index_rows(pages: DataFrame, origin: str) -> DataFrame:
    """Links of all table rows of index pages that lead to company profiles: page columns, ord, url, text, ticker."""
    from ..functions import urls
    from .filters import company_links

    rows = parsed(pages, "tables").withColumn("links", F.flatten(F.transform("tables", lambda t: t["links"]))).drop("tables")
    keys = [c for c in rows.columns if c not in ("links", "url")]
    links = exploded(rows, "links", *keys).where(F.lower("url").contains("/quotes/") | F.lower("url").contains("symbol"))
    return company_links(links.withColumn("url", urls.prefixed(F.col("url"), origin)))


def index_cells(pages: DataFrame) -> DataFrame:
    """Symbol and company of all table rows with links, by their first two cells: page columns, ord, symbol, company, url."""
    rows = parsed(pages, "index")
    return exploded(rows, "index", *(c for c in rows.columns if c not in ("index", "url"))).where("symbol <> '' and company <> ''")
