"""HTML pages to Markdown: links made absolute, tables with spanning cells kept as HTML, all else converted. One parse per page.

Built on the standard library's tokenizer; structure is kept (headings, emphasis, links, images, lists, quotes, code, tables), exact bytes of any third-party
converter are not reproduced. Null gives null, the empty page the empty text; unclosed elements end with the page.
"""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafmill.functions import text as T

VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
SILENT = {"script", "style", "head", "title", "noscript", "template"}
BLOCKS = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "figure", "form", "address", "dl", "dt", "dd", "fieldset"}
#: Elements that the start of another one closes (implied end tags).
IMPLIED = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
WALLS = {"table", "ul", "ol", "body", "html", "div", "section"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def descendants(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.descendants()


class Tree(HTMLParser):
    """Builds the page's element tree with implied end tags."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.root, self.base = Node("html"), base.rstrip("/")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in IMPLIED.get(tag, ()):
                del self.open[k:]
                break
            if self.open[k].tag in WALLS:
                break
        values = dict(attrs)
        for name in ("src", "href"):
            owner = {"src": "img", "href": "a"}[name]
            if tag == owner and (values.get(name) or "").startswith("/"):
                values[name] = self.base + values[name]
        node = Node(tag, values)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str, base: str = "") -> Node:
    tree = Tree(base)
    tree.feed(html)
    tree.close()
    return tree.root


def to_html(node: Node | str) -> str:
    if isinstance(node, str):
        return escape(node, quote=False)
    attrs = "".join(f" {k}" if v is None else f' {k}="{escape(v)}"' for k, v in node.attrs.items())
    return f"<{node.tag}{attrs}>" + ("" if node.tag in VOID else "".join(map(to_html, node.children)) + f"</{node.tag}>")


def spans_cells(table: Node) -> bool:
    """Whether any cell below a table has a colspan or rowspan that isn't empty."""
    return any(n.tag in ("td", "th") and (n.attrs.get("colspan") or n.attrs.get("rowspan")) for n in table.descendants())


def _inline(node: Node | str) -> str:
    if isinstance(node, str):
        return re.sub(r"\s+", " ", node)
    if node.tag in SILENT:
        return ""
    inner = "".join(map(_inline, node.children))
    mark = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~"}.get(node.tag)
    if mark:
        core = inner.strip()
        return inner if not core else inner.replace(core, mark + core + mark, 1)
    if node.tag == "code":
        return f"`{inner}`"
    if node.tag == "br":
        return "  \n"
    if node.tag == "img":
        return f"![{node.attrs.get('alt') or ''}]({node.attrs.get('src') or ''})"
    if node.tag == "a":
        href, core = node.attrs.get("href"), inner.strip()
        return inner if not href or not core else f"[{core}]({href})"
    return inner


def _text(node: Node | str) -> str:
    return node if isinstance(node, str) else "".join(map(_text, node.children))


def _list(node: Node, level: int) -> list[str]:
    out, number = [], int(node.attrs.get("start") or 1) if (node.attrs.get("start") or "1").isdigit() else 1
    for item in (c for c in node.children if isinstance(c, Node) and c.tag == "li"):
        head = "".join(_inline(c) for c in item.children if isinstance(c, str) or c.tag not in ("ul", "ol")).strip()
        out.append("  " * level + (f"{number}. " if node.tag == "ol" else "* ") + head)
        number += 1
        for c in item.children:
            if isinstance(c, Node) and c.tag in ("ul", "ol"):
                out += _list(c, level + 1)
    return out


def _table(node: Node) -> str:
    rows = [[_inline(c).strip().replace("|", "\\|").replace("\n", " ") for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in node.descendants() if r.tag == "tr"]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    return "\n".join(["| " + " | ".join(rows[0]) + " |", "| " + " | ".join(["---"] * width) + " |", *("| " + " | ".join(r) + " |" for r in rows[1:])])


def _blocks(node: Node) -> list[str]:
    """The Markdown blocks of an element."""
    out: list[str] = []
    run: list[Node | str] = []

    def flush():
        text = "".join(map(_inline, run))
        run.clear()
        if text.strip():
            out.append("\n".join(line.strip() if not line.endswith("  ") else line.lstrip() for line in text.split("\n")).strip())

    for c in node.children:
        if isinstance(c, str) or c.tag not in BLOCKS | {"ul", "ol", "table", "pre", "blockquote", "hr", "html", "body", "h1", "h2", "h3", "h4", "h5", "h6"} | SILENT:
            if not isinstance(c, str) and any(d.tag in ("table", "ul", "ol", "p", "div") for d in c.descendants()):
                flush()
                out += _blocks(c)
            else:
                run.append(c)
            continue
        flush()
        if c.tag in SILENT:
            continue
        if re.fullmatch("h[1-6]", c.tag):
            title = "".join(map(_inline, c.children)).strip()
            if title:
                out.append("#" * int(c.tag[1]) + " " + title)
        elif c.tag in ("ul", "ol"):
            items = _list(c, 0)
            if items:
                out.append("\n".join(items))
        elif c.tag == "table":
            out.append(to_html(c) if spans_cells(c) else _table(c))
        elif c.tag == "pre":
            out.append("```\n" + _text(c).strip("\n") + "\n```")
        elif c.tag == "blockquote":
            out.append("\n".join("> " + line if line else ">" for line in "\n\n".join(_blocks(c)).split("\n")))
        elif c.tag == "hr":
            out.append("---")
        else:
            out += _blocks(c)
    flush()
    return [b for b in out if b]


def page_markdown(html: str, base: str = "") -> str:
    return "\n\n".join(_blocks(parse(html, base)))


def html_to_markdown(html: Column, base: Column) -> Column:
    """Arrow-batched conversion of a page with its site's address."""

    @F.pandas_udf(StringType())
    def convert(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else page_markdown(h, b or "") for h, b in zip(pages, bases)])

    return convert(html, base)


def absolute_links(html: Column, base: Column) -> Column:
    """Simple HTML with the site's address before ``href`` and ``src`` values that start with ``/`` (also before ``//host``, as stated for this operator)."""
    base = F.regexp_replace(F.rtrim(base, F.lit("/")), r"([\\$])", r"\\$1")  # taken literally in the replacement
    return F.regexp_replace(html, F.lit(r'(?i)(<(?:a|img)\b[^>]*?\b(?:href|src)=")/'), F.concat(F.lit("$1"), base, F.lit("/")))


def page_title(html: Column, page_id: Column) -> Column:
    found = F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)
    return F.coalesce(T.filled(T.strip(found)), F.concat(F.lit("page_"), page_id))
