"""Main content of web pages kept as Markdown.

Method: layout-aware rendering. A tree builder turns the page's lines into a tree: frame elements with implied end tags, sections with implied
ends at the next heading of their level, and in them the blocks (headings, lists, tables, fenced code, paragraphs). Visibility rules hide the nodes of the
page frame, and the renderer emits all visible text with block spacing, list markers and aligned table cells.

Visibility rules, none of which knows a site's sentences:

1. What stands before the page's title heading is frame.
2. Frame markup is hidden, and elements with ``hidden`` or ``display:none`` with all they hold; a missing end tag is implied at the title or the end.
3. Lines of links only are hidden if they lead to anchors of the page or into the site itself (menus, sidebars, tools, contents).
4. A group of lines (between blank lines) is hidden if all its lines recur: they stand on at least ``MIN_PAGES`` different pages of the site. Digit runs, case and
   white space don't count; copies of a page are one page, by the least hash of their longer lines, and a line whose pages are mostly copies doesn't recur.
   Headings, table rows and code never count as recurring by themselves.
5. A heading with links of the frame (rule 3) right behind it is hidden if it recurs in that place and doesn't recur in front of content; if it recurs in
   neither, it is hidden if all of its section is. A comments heading hides the rest of the page.
6. In the closing run of the page (groups with only hidden groups behind them) label lines (``key: word, word``) whose key recurs are hidden, and lines that
   open with a general cue of page footers (``CUES``, also the optional ``phrases``); likewise in the opening run of a page without a title.

Defined results: null and blank pages have no lines and the empty text; pages without a title heading have no head region; repeated rows of a page are one
page; a null site is a site of its own; a code block without its end fence ends before its first blank line; without a site address rule 3 takes the host of the
page's attachment and menu links.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.repeats import MIN_PAGES, compared_lines, known_templates, line_digest
from leafmill.operators.ranking import bounded_broadcast, distinct_texts
from leafmill.session import spread

#: Headings that open the comments, which end the page's content.
COMMENTS = [r"^(?:#+ )?评论$", r"^(?:#+ )?全部评论 ?[(（]\d+[)）]", r"^(?:#+ )?comments$", r"^(?:#+ )?\d+ comments?$", r"^(?:#+ )?kommentare$", r"^(?:#+ )?\d+ kommentare?$"]
#: General openings of footer lines by language, looked for in the opening and closing runs only.
CUES = {
    "any": [r"©", r"\(c\) ?\d{4}", r"🍪"],
    "en": [r"copyright\b", r"all rights reserved", r"privacy\b", r"terms of\b", r"imprint\b", r"(?:this|our) (?:web)?site (?:uses|stores)\b", r"we use cookies", r"share (?:this|on)\b", r"subscribe\b", r"follow us\b", r"back to top", r"powered by\b", r"sign in\b", r"log ?in\b", r"was this page helpful"],
    "de": [r"impressum\b", r"datenschutz", r"agb\b", r"diese (?:web)?seite (?:verwendet|nutzt|speichert)\b", r"alle rechte vorbehalten", r"teilen\b", r"nach oben\b", r"newsletter\b", r"anmelden\b", r"kontakt$"],
    "zh": [r"版权所有", r"隐私政策", r"使用条款", r"本站使用", r"分享到", r"返回顶部", r"订阅", r"登录$"],
}

_TITLE = re.compile(r"^\s*# +\S")
_FENCE = re.compile(r"^\s*(?:```|~~~)")
_HEADING = re.compile(r"^\s*(#{1,6})\s+(.*)$")
_ITEM = re.compile(r"^(\s*)((?:[-*+]|\d+[.)])\s+)(.*)$")
_TABLE = re.compile(r"^\s*\|.*\|\s*$")
_RULE_ROW = re.compile(r"^\s*\|(?:\s*:?-+:?\s*\|)+\s*$")
_FRAME = re.compile(r"^(?:\s*(?:</?(?:div|nav|span|header|footer|aside|section|main|a|script|style|iframe|form|input|button|svg|img)\b[^>]*>|<!--.*?-->))+\s*$", re.I)
_OPEN = re.compile(r"<(div|nav|span|header|footer|aside|section|main)\b([^>]*)>", re.I)
_CLOSE = re.compile(r"</(div|nav|span|header|footer|aside|section|main)\s*>", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_LINK = re.compile(r"\[[^\]\[]*\]\(([^()\s]*)\)")
_BETWEEN = re.compile(r"^[\s*+\-·|,/→←«»‹›<>:：•]*(?:\d+[.)]\s*)?$")
_NAV_WORDS = re.compile(r"(?:zurück|weiter|prev(?:ious)?|next|上一[篇页]|下一[篇页]|back|older|newer|älter|neuer)\s*[:：]?", re.I)
_SITE = re.compile(r"\((https?://[^/()\s]+/[^/()\s]+)/(?:pages/viewpageattachments|spaces|browsepeople|calendars|shortcuts|people|start|keys|logout)", re.I)
_LABELS = re.compile(r"^([^:：\d]{2,30})[:：] ?[^\s,，、.。:：]+(?:[,，、] ?[^\s,，、.。:：]+)*$")
_WORDY = re.compile(r"\w")
#: Lines of at least this many characters take part in a page's signature.
SIGNATURE_CHARS = 40


class PageRules:
    """The compiled cues: comments headings, footer openings and optional phrases of the user's own (patterns by language)."""

    def __init__(self, phrases: dict[str, list[str]] | None = None, comments: list[str] | None = None, cues: dict[str, list[str]] | None = None):
        every = [p.removeprefix("^") for group in [*(CUES if cues is None else cues).values(), *(phrases or {}).values()] for p in group]
        self.cues = re.compile("|".join(f"(?:{p})" for p in every)) if every else None
        self.comments = re.compile("|".join(comments or COMMENTS))

    def is_frame(self, line: str) -> bool:
        return line.lstrip().startswith("<") and bool(_FRAME.match(line))

    def is_comments(self, folded: str) -> bool:
        return bool(self.comments.match(folded))

    def is_cue(self, folded: str) -> bool:
        return bool(self.cues and self.cues.match(folded.lstrip("#>*+- ").lstrip()))


def _link_line(line: str, site: str | None) -> bool:
    """Whether a line holds only links, and all lead to anchors or into the site."""
    if "](" not in line:
        return False
    targets = _LINK.findall(line)
    if not targets:
        return False
    rest = _NAV_WORDS.sub("", _LINK.sub("", line))
    if not _BETWEEN.match(rest):
        return False
    return all(t.startswith("#") or (site is not None and t.lower().startswith(site)) for t in targets)


class Node:
    """A node of the page's tree: the page, a section, an element, or a block with lines (number, text).

    ``group`` numbers the stretches between blank lines; ``visible`` is None until a rule decides.
    """

    __slots__ = ("kind", "level", "hidden", "lines", "children", "group", "visible")

    def __init__(self, kind: str, level: int = 0, hidden: bool = False, group: int = 0):
        self.kind, self.level, self.hidden, self.group, self.visible = kind, level, hidden, group, None
        self.lines: list[tuple[int, str]] = []
        self.children: list[Node] = []

    def blocks(self):
        stack = [self]
        while stack:
            node = stack.pop()
            if node.lines:
                yield node
            stack.extend(reversed(node.children))


def _site_prefix(markdown: str, site: str | None) -> str | None:
    if site is None and (m := _SITE.search(markdown)):
        site = m[1]
    return site.rstrip("/").lower() + "/" if site else None


def build_tree(markdown: str, folded: list[str], rules: PageRules, site: str | None = None) -> Node:
    """The page's tree. Block kinds: head, frame, comment, link, heading, table, list, code, text; the rules that need one page only are applied.
    ``folded`` are the lines in compared form."""
    lines = markdown.split("\n")
    prefix = _site_prefix(markdown, site)
    title = next((i for i, x in enumerate(folded) if x.startswith("# ") and _TITLE.match(lines[i])), None)
    root = Node("page")
    open_nodes = [root]
    group, code_end, over = 0, -1, False

    def add(kind: str, number: int, text: str, joins: bool = True, visible: bool | None = None) -> None:
        parent = open_nodes[-1]
        last = parent.children[-1] if parent.children else None
        if last is None or not joins or last.kind != kind or last.group != group:
            last = Node(kind, group=group)
            last.visible = False if len(open_nodes) > 1 and any(n.hidden for n in open_nodes) else visible
            parent.children.append(last)
        last.lines.append((number, text))

    for i, line in enumerate(lines):
        if i <= code_end:
            add("code", i + 1, line, visible=True)
            continue
        bare = line.strip()
        if not bare:
            group += 1
            continue
        if title is not None and i < title:
            add("head", i + 1, line, visible=False)
            continue
        if i == title:
            del open_nodes[1:]  # end tags that are missing in the head are implied
        first = bare[0]
        if first in "`~" and not over and _FENCE.match(line):
            code_end = _code_end(lines, i)
            add("code", i + 1, line, joins=False, visible=True)
            continue
        if first == "<" and rules.is_frame(line):
            for tag, rest in _OPEN.findall(line):
                node = Node(tag.lower(), level=-1, hidden=bool(_HIDDEN.search(rest)))
                open_nodes[-1].children.append(node)
                open_nodes.append(node)
            add("frame", i + 1, line, visible=False)
            for tag in _CLOSE.findall(line):
                at = next((k for k in range(len(open_nodes) - 1, 0, -1) if open_nodes[k].kind == tag.lower()), None)
                if at is not None:
                    del open_nodes[at:]  # sections and elements that are open in it end with it
            continue
        if not over and rules.is_comments(folded[i]):
            over = True
        if over:
            add("comment", i + 1, line, visible=False)
        elif first == "#" and (m := _HEADING.match(line)):
            level = len(m[1])
            while open_nodes[-1].kind == "section" and open_nodes[-1].level >= level:
                open_nodes.pop()
            section = Node("section", level)
            open_nodes[-1].children.append(section)
            open_nodes.append(section)
            add("heading", i + 1, line, joins=False, visible=True if i == title else None)
        elif "](" in line and _link_line(line, prefix):
            add("link", i + 1, line, visible=False)
        elif first == "|" and bare[-1] == "|" and len(bare) > 1:
            add("table", i + 1, line)
        elif (first in "-*+" or first.isdigit()) and _ITEM.match(line):
            add("list", i + 1, line)
        else:
            add("text", i + 1, line)
    return root


def _code_end(lines: list[str], start: int) -> int:
    """The last line of the code block that opens at ``start``. A block whose next fence opens another (it names a language), or that has none, ends
    before its first blank line."""
    after = next((k for k in range(start + 1, len(lines)) if _FENCE.match(lines[k])), None)
    if after is not None and len(lines[after].strip()) == 3:
        return after
    blank = next((k for k in range(start + 1, len(lines)) if not lines[k].strip()), len(lines))
    return min(blank, len(lines) if after is None else after) - 1


def label_key(folded: str) -> str | None:
    """The key of a label line (``key: word, word``), or None. A key is never equal to a line."""
    m = _LABELS.match(folded)
    return m[1].strip() + ":\x01" if m else None


def _undecided(root: Node):
    """The blocks that recurrence decides on."""
    return [b for b in root.blocks() if b.visible is None and b.kind in ("list", "text")]


def _headings(root: Node):
    """The undecided headings, each with whether links of the frame stand right behind it."""
    blocks = list(root.blocks())
    for b, after in zip(blocks, [*blocks[1:], None]):
        if b.kind == "heading" and b.visible is None:
            yield b, after is not None and after.kind == "link"


def _heading_form(folded: str, before_links: bool) -> str:
    return folded + ("\x02" if before_links else "\x03")


def page_templates(markdown: str, rules: PageRules, site: str | None = None) -> tuple[set[str], str]:
    """(compared forms of the lines that may recur, with the keys of label lines; the page's signature)."""
    folded = compared_lines(markdown)
    forms: set[str] = set()
    root = build_tree(markdown, folded, rules, site)
    forms.update(_heading_form(folded[h.lines[0][0] - 1], ahead) for h, ahead in _headings(root))
    for block in _undecided(root):
        for n, _ in block.lines:
            forms.add(folded[n - 1])
            if key := label_key(folded[n - 1]):
                forms.add(key)
    longer = [line_digest(f) for f in set(folded) if len(f) >= SIGNATURE_CHARS and "](" not in f]
    return forms, min(longer, default=line_digest(markdown)).hex()


def build(markdown: str, rules: PageRules, site: str | None = None, recurs=lambda form: False) -> Node:
    """The page's tree with every block decided. ``recurs`` says whether a compared form recurs on the site."""
    folded = compared_lines(markdown)
    root = build_tree(markdown, folded, rules, site)
    blocks = list(root.blocks())
    groups: dict[int, list[Node]] = {}
    for b in blocks:
        groups.setdefault(b.group, []).append(b)
    for members in groups.values():
        open_ones = [b for b in members if b.visible is None and b.kind != "heading"]
        if open_ones and all(b.kind in ("list", "text") and all(recurs(folded[n - 1]) for n, _ in b.lines) for b in open_ones) and not any(b.visible for b in members):
            for b in open_ones:
                b.visible = False
    _decide_headings(root, folded, recurs)

    def closes(block: Node) -> bool:
        return block.kind in ("list", "text") and all(
            recurs(form) or ((key := label_key(form)) is not None and recurs(key)) or rules.is_cue(form) for form in (folded[n - 1] for n, _ in block.lines)
        )

    titled = any(b.kind == "head" for b in blocks) or any(b.visible for b in blocks if b.kind == "heading")
    for order in ([list(groups.values())[::-1]] if titled else [list(groups.values())[::-1], list(groups.values())]):
        for members in order:
            open_ones = [b for b in members if b.visible is not False]
            if any(b.visible for b in open_ones) or not all(closes(b) for b in open_ones):
                break
            for b in open_ones:
                b.visible = False
    _decide_headings(root, folded, recurs)
    for b in blocks:
        if b.visible is None:
            b.visible = True
    return root


def _decide_headings(root: Node, folded: list[str], recurs) -> None:
    """Rule 5."""
    sections, todo = {}, [root]
    while todo:
        node = todo.pop()
        if node.kind == "section":
            sections[id(node.children[0])] = node
        todo.extend(node.children)
    for heading, ahead in reversed(list(_headings(root))):  # inner sections first
        form = folded[heading.lines[0][0] - 1]
        in_front_of_content = recurs(_heading_form(form, False))
        if ahead and not in_front_of_content:
            inside = [b for b in sections[id(heading)].blocks() if b is not heading]
            if recurs(_heading_form(form, True)) or all(b.visible is False for b in inside):
                heading.visible = False


def hidden_lines(markdown: str | None, rules: PageRules, site: str | None = None, recurs=lambda form: False) -> list[int]:
    """Numbers of the non-blank lines that aren't the page's own content."""
    if not markdown or not markdown.strip():
        return []
    return sorted(n for b in build(markdown, rules, site, recurs).blocks() if not b.visible for n, t in b.lines if t.strip())


def _width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _table(rows: list[str]) -> list[str]:
    cells = [[c.strip() for c in r.strip().strip("|").split("|")] for r in rows if not _RULE_ROW.match(r)]
    columns = max((len(r) for r in cells), default=0)
    widths = [max((_width(r[k]) for r in cells if k < len(r)), default=0) for k in range(columns)]
    return ["  ".join(c + " " * (w - _width(c)) for c, w in zip(r + [""] * (columns - len(r)), widths)).rstrip() for r in cells]


def render(markdown: str | None, rules: PageRules, site: str | None = None, recurs=lambda form: False) -> str:
    """The visible text: one blank line between blocks, list markers and nesting kept, table cells aligned, code as it is."""
    if not markdown or not markdown.strip():
        return ""
    out: list[str] = []
    for block in build(markdown, rules, site, recurs).blocks():
        if not block.visible:
            continue
        texts = [t.rstrip() for _, t in block.lines]
        if block.kind == "table":
            texts = _table(texts)
        elif block.kind == "list":
            texts = [f"{m[1]}{m[2].strip()} {' '.join(m[3].split())}" if (m := _ITEM.match(t)) else t for t in texts]
        elif block.kind in ("text", "heading"):
            texts = [" ".join(t.split()) for t in texts]
        if out:
            out.append("")
        out.extend(texts)
    return "\n".join(out)


def _pages(pages: DataFrame, sites: DataFrame | None, page: str, tree: str, text: str) -> DataFrame:
    """(site, page, text, address) of the pages with text."""
    rows = spread(pages.where(F.col(page).isNotNull() & F.col(text).rlike(r"\S")).select(F.col(tree).alias("site"), F.col(page).alias("page"), F.col(text).alias("text")))
    if sites is None:
        return rows.withColumn("address", F.lit(None).cast("string"))
    home = sites.groupBy(F.col("tree_id").alias("t")).agg(F.max("base_url").alias("address"))
    return rows.join(bounded_broadcast(home), F.col("site") == F.col("t"), "left").select("site", "page", "text", "address")


def _recurring(rows: DataFrame, rules: PageRules, min_pages: int):
    """The site's recurring forms, as a lookup for tasks (see :func:`leafmill.llm.repeats.known_templates`)."""

    def forms(site, page, text, address):
        found, signature = page_templates(text, rules, address)
        return found, signature

    return known_templates(rows, forms, min_pages, copies=True)


def boilerplate_lines(pages: DataFrame, sites: DataFrame | None = None, phrases: dict[str, list[str]] | None = None, page: str = "page_id", tree: str = "tree_id", text: str = "markdown", min_pages: int = MIN_PAGES) -> DataFrame:
    """(page, line_no): the non-blank lines that aren't the page's own content. Each pair once."""
    rules = PageRules(phrases)
    rows = _pages(pages, sites, page, tree, text)
    known = _recurring(rows, rules, min_pages)

    def run(batches):
        for batch in batches:
            names, numbers = [], []
            for site, name, body, address, extra in zip(*(c.to_pylist() for c in batch.columns)):
                found = hidden_lines(body, rules, address, known.lookup(site, extra))
                names += [name] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32())], names=[page, "line_no"])

    return known.attached(rows).mapInArrow(run, f"`{page}` string, line_no int").distinct()


def main_content(pages: DataFrame, sites: DataFrame | None = None, phrases: dict[str, list[str]] | None = None, page: str = "page_id", tree: str = "tree_id", text: str = "markdown", min_pages: int = MIN_PAGES) -> DataFrame:
    """(page, content): the rendered own content of each page; repeated rows once."""
    rules = PageRules(phrases)
    rows = _pages(distinct_texts(pages.where(F.col(text).rlike(r"\S")).select(page, tree, text), [page, tree], text), sites, page, tree, text)
    known = _recurring(_pages(pages, sites, page, tree, text), rules, min_pages)

    def run(batches):
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            texts = [render(t, rules, a, known.lookup(s, x)) for s, t, a, x in zip(cols[0], cols[2], cols[3], cols[4])]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.string())], names=[page, "content"])

    return known.attached(rows).mapInArrow(run, f"`{page}` string, content string")
