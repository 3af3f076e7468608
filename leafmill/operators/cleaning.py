"""The wiki-page cleaning chain as DataFrame steps.

Every step takes a DataFrame and the name of a text column and returns the DataFrame with that column changed, so that each is its own
projection: chaining them keeps the plan linear, while nesting them in one expression would multiply it. Two steps that scan lines
sequentially (bylines, navigation blocks) are Arrow-batched Python; all others are JVM expressions.

Null texts stay null through single steps. Extra columns pass through.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafmill.functions import text as T
from leafmill.operators.bylines import LINES, byline

#: Fixed values of the default rule set, replaceable through the ``rules`` arguments.
TAIL_MARKERS = ["## 评论", "无标签", "写评论...", "概览\n\n内容工具", "基于 Atlassian Confluence", '{"serverDuration":', "search\n\nrecentlyviewed", "更新恢复页面保留草稿取消"]
SKIP_MENU = ["转至内容", "转至导航栏", "转至主菜单", "转至动作菜单", "转至快速搜索"]
RELATED_HINTS = ["已链接应用程序"]
NAV_WORDS = ["空间", "人员", "日程表", "创建空白页", "在线帮助", "快捷键", "注销"]
TREE_START, TREE_END = "##### 页面树结构", "重排页面"
BUTTONS = ["E编辑", "F收藏", "S分享", "导出为PDF", "Doc文件导入"]
ANCHORS = ["跳到banner的尾部", "回到标题开始", "转至元数据结尾", "转至元数据起始"]
HEAD_LINES, NAV_HITS, TITLE_LINES, TITLE_CHARS, COUNT_WINDOW = 120, 3, 8, 200, 220

_ATTACH_PAGE = r"(?iU)https?://[^)\s\"']+/pages/viewpageattachments\.action\?pageId=\d+"
_FILE_URL = r"https?://[^)\s\"']+/download/attachments/[^/]+/[^)\s\"']+"


def attachments_index(df: DataFrame, raw: str, out: str = "attachments_index") -> DataFrame:
    """Adds ``out``: a Markdown list of the distinct attachment pages linked in ``raw``, with the count that stands before the link; empty if none."""
    df = df.withColumn("__urls", F.array_distinct(F.regexp_extract_all(F.col(raw), F.lit(_ATTACH_PAGE), F.lit(0))))

    def item(url: Column) -> Column:
        at = F.regexp_instr(F.col(raw), F.concat(F.lit(r"\Q"), url, F.lit(r"\E(?!\d)")))
        before = F.substring(F.col(raw), F.greatest(at - COUNT_WINDOW, F.lit(1)), F.least(at - 1, F.lit(COUNT_WINDOW)))
        count = T.attachment_count(before)
        label = F.when(count.isNotNull(), F.concat(F.lit("共 "), count, F.lit(" 个"))).otherwise("本页")
        return F.concat(F.lit("* [附件与文件管理（"), label, F.lit("）]("), url, F.lit(")"))

    df = df.withColumn("__items", F.transform("__urls", item))
    made = F.when(F.size("__items") > 0, F.concat(F.lit("## 附件与文件\n"), F.array_join("__items", "\n"), F.lit("\n\n"))).otherwise("")
    return df.withColumn(out, made).drop("__urls", "__items")


def take_metadata(df: DataFrame, text: str, author: str = "author", last_modified: str = "last_modified", error: str | None = None) -> DataFrame:
    """Removes bylines from ``text`` and adds their author and date (empty where missing), with ``error`` also what went wrong in a text (null if nothing)."""
    df = df.withColumn("__byline", byline(F.col(text)))
    fields = {text: F.col("__byline.text"), author: F.col("__byline.author"), last_modified: F.col("__byline.last_modified")}
    return df.withColumns(fields | ({error: F.col("__byline.error")} if error else {})).drop("__byline")


def cut_head(df: DataFrame, text: str) -> DataFrame:
    """Drops all through the first line-initial metadata-start link and the white space behind it; unchanged without one."""
    mark = rf"(?Umd)^{T.WS}*\[{ANCHORS[3]}\]{T.WS}*\([^)]*\){T.WS}*"
    found = F.contains(F.col(text), F.lit(ANCHORS[3])) & F.col(text).rlike(mark)
    return df.withColumn(text, F.when(found, T.lstrip_newlines(F.element_at(F.split(F.col(text), mark, 2), 2))).otherwise(F.col(text)))


def prepend_front_matter(df: DataFrame, text: str, author: str = "author", last_modified: str = "last_modified") -> DataFrame:
    body = T.lstrip_newlines(F.regexp_replace(F.col(text), r"\A\ufeff+", ""))
    head = F.concat(F.lit("---\nauthor: "), T.yaml_scalar(F.col(author)), F.lit("\nlast_modified: "), T.yaml_scalar(F.col(last_modified)), F.lit("\n---\n\n"))
    return df.withColumn(text, F.concat(head, body))


def cut_tail(df: DataFrame, text: str, markers: list[str] | None = None) -> DataFrame:
    """Drops all from the line of the earliest marker on; unchanged without one."""
    found = F.filter(F.array(*[F.locate(m, F.col(text)) for m in markers or TAIL_MARKERS]), lambda p: p > 0)
    df = df.withColumn("__at", F.array_min(found)).withColumn("__before", F.substring(F.col(text), F.lit(1), F.coalesce(F.col("__at") - 1, F.lit(0))))
    last = F.locate("\n", F.reverse(F.col("__before")))
    df = df.withColumn("__kept", T.rstrip(F.when(last > 0, F.substring(F.col("__before"), F.lit(1), F.length("__before") - last + 1)).otherwise("")))
    kept = F.when(F.col("__kept") == "", "").otherwise(F.concat("__kept", F.lit("\n")))
    return df.withColumn(text, F.when(F.col("__at").isNull(), F.col(text)).otherwise(kept)).drop("__at", "__before", "__kept")


def _front_matter_end(x: Column) -> Column:
    """Length of the leading front matter, 0 without one."""
    at = F.locate("\n---\n", x, 5)
    return F.when(x.startswith("---\n") & (at > 0), at + 4).otherwise(0)


def on_body(df: DataFrame, text: str, *steps) -> DataFrame:
    """Applies steps to the text behind the front matter."""
    df = df.withColumn("__fm", _front_matter_end(F.col(text)))
    df = df.withColumns({"__head": F.substring(F.col(text), F.lit(1), F.col("__fm")), "__body": F.when(F.col(text).isNotNull(), F.substring(F.col(text), F.col("__fm") + 1, F.length(text)))}).drop("__fm")
    for step in steps:
        df = step(df, "__body")
    return df.withColumn(text, F.concat("__head", "__body")).drop("__head", "__body")


_LIST_LINE = re.compile(r"\s*[-*+]\s")


def without_navigation(body: str, skip: list[str], related: list[str], nav: list[str]) -> str:
    """Removes menu and hint list lines and navigation clusters that start among the first HEAD_LINES lines that are left.

    A cluster runs from a list line with a navigation word through the list until NAV_HITS different words were met; it goes up to that line. Lines are
    consumed from a stack; ``kept`` holds what stays, so the window counts remaining lines.
    """
    rest = LINES.findall(body)
    rest.reverse()
    kept: list[str] = []
    while rest and len(kept) < HEAD_LINES:
        line = rest[-1]
        if _LIST_LINE.match(line):
            rule = skip if any(w in line for w in skip) else related if any(w in line for w in related) else None
            if rule is not None:
                while rest and _LIST_LINE.match(rest[-1]) and any(w in rest[-1] for w in rule):
                    rest.pop()
                continue
            if any(w in line for w in nav):
                met: set[str] = set()
                size = 0
                while size < len(rest) and _LIST_LINE.match(rest[-1 - size]) and len(met) < NAV_HITS:
                    met |= {w for w in nav if w in rest[-1 - size]}
                    size += 1
                if len(met) >= NAV_HITS:
                    del rest[-size:]
                    continue
        kept.append(rest.pop())
    return "".join(kept) + "".join(reversed(rest))


def remove_navigation(df: DataFrame, text: str, skip: list[str] | None = None, related: list[str] | None = None, nav: list[str] | None = None) -> DataFrame:
    rules = (skip or SKIP_MENU, related or RELATED_HINTS, nav or NAV_WORDS)
    words = [w for group in rules for w in group]

    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: without_navigation(t, *rules) if t is not None and any(w in t for w in words) else t)

    # declared non-deterministic so that the optimizer doesn't copy it into the steps behind it
    return df.withColumn(text, F.pandas_udf(clean, StringType()).asNondeterministic()(F.col(text)))


def remove_tree_sidebar(df: DataFrame, text: str) -> DataFrame:
    """Removes the page tree: through the first line with the end word or up to the next title heading, whichever ends earlier; with neither, to
    the end."""
    df = df.withColumn("__at", F.locate(TREE_START, F.col(text))).withColumn("__rest", F.substring(F.col(text), F.col("__at"), F.length(text)))
    row = F.regexp_extract(F.col("__rest"), rf"(?d)\A[\s\S]*?({TREE_END}[^\n]*)", 0)
    title = F.regexp_instr(F.col("__rest"), F.lit(r"(?Umd)^#\s++.+$"))
    end = F.least(F.when(row != "", F.length(row) + 1), F.when(title > 0, title))
    df = df.withColumn("__end", end).withColumn("__before", F.substring(F.col(text), F.lit(1), F.col("__at") - 1))
    cut = F.when(F.col("__end").isNull(), F.concat(T.rstrip(F.col("__before")), F.lit("\n"))).otherwise(F.concat("__before", F.substring(F.col("__rest"), F.col("__end"), F.length("__rest"))))
    return df.withColumn(text, F.when(F.col("__at") > 0, cut).otherwise(F.col(text))).drop("__at", "__rest", "__end", "__before")


def _where_any(df: DataFrame, text: str, words: list[str], pattern: str) -> DataFrame:
    """Removes a pattern from texts that hold one of its words at all; others aren't scanned, whatever white space they have."""
    has = F.contains(F.col(text), F.lit(words[0]))
    for w in words[1:]:
        has = has | F.contains(F.col(text), F.lit(w))
    return df.withColumn(text, F.when(has, F.regexp_replace(F.col(text), pattern, "")).otherwise(F.col(text)))


def remove_buttons(df: DataFrame, text: str, buttons: list[str] | None = None) -> DataFrame:
    """Removes list lines that are a link with a button's label. Two passes reach the fixpoint."""
    pattern = rf"(?Umd)^{T.WS}*[*+]{T.WS}*\[(?:{'|'.join(map(re.escape, buttons or BUTTONS))})\][^\n]*{T.WS}*$"
    for _ in range(2):
        df = _where_any(df, text, buttons or BUTTONS, pattern)
    return df


def clean_ui(df: DataFrame, text: str) -> DataFrame:
    return on_body(df, text, remove_navigation, remove_tree_sidebar, remove_buttons)


def remove_anchors(df: DataFrame, text: str) -> DataFrame:
    return _where_any(df, text, ANCHORS, rf"\[(?:{'|'.join(ANCHORS)})\]\([^)]*\)")


def remove_avatars(df: DataFrame, text: str) -> DataFrame:
    return _where_any(df, text, ["添加头像"], rf"(?U)\[!\[用户图标:{T.WS}*添加头像\]\([^)]*\)\]\([^)]*\){T.WS}*")


def remove_hash_links(df: DataFrame, text: str) -> DataFrame:
    return _where_any(df, text, ["](#)"], rf"(?Umd)^{T.WS}*[*+-]{T.WS}*\[[^\]]+\]\(#\){T.WS}*$")


def remove_breadcrumb(df: DataFrame, text: str) -> DataFrame:
    """Removes the numbered links at the very start, with the line breaks around them."""
    return df.withColumn(text, F.regexp_replace(F.col(text), rf"(?Umd)\A\n*(?:\d+\.{T.WS}+\[[^\]]+\]\([^)]*\){T.WS}*(?:\r?\n|$))+\n*", ""))


def clean_anchors(df: DataFrame, text: str) -> DataFrame:
    return on_body(df, text, remove_anchors, remove_avatars, remove_hash_links, remove_breadcrumb)


def dedupe_titles(df: DataFrame, text: str) -> DataFrame:
    """Folds the opening lines that repeat the title into one ``# title``. May drop short real lines that the title contains."""
    block_of_fm = F.regexp_extract(F.col(text), r"(?s)\A---\r?\n.*?\r?\n---\r?\n", 0)
    df = df.withColumn("__head", block_of_fm).withColumn("__body", F.substring(F.col(text), F.length("__head") + 1, F.length(text)))
    df = df.withColumn("__all", T.split_lines(F.col("__body")))
    first = F.array_min(F.filter(F.transform("__all", lambda x, i: F.when(T.strip(x) != "", i + 1)), lambda i: i.isNotNull()))
    df = df.withColumn("__first", first).withColumn("__lines", F.when(F.col("__first").isNotNull(), F.slice("__all", F.col("__first"), F.size("__all"))))
    df = df.withColumn("__opening", F.transform(F.slice("__lines", 1, TITLE_LINES), lambda x: T.strip(x)))
    heading = lambda s: s.rlike(r"(?U)\A#{1,6}\s+\S")
    counts = lambda s: heading(s) | ((s != "") & (F.length(s) < TITLE_CHARS) & ~s.rlike(r"\A[-*+#]"))
    stop = F.array_min(F.filter(F.transform("__opening", lambda s, i: F.when(~counts(s), i)), lambda i: i.isNotNull()))
    df = df.withColumn("__size", F.coalesce(stop, F.size("__opening")))
    df = df.withColumn("__block", F.when(F.col("__size") > 0, F.slice("__opening", 1, F.greatest("__size", F.lit(1)))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__norms", F.transform("__block", lambda s, i: F.struct(i.alias("i"), T.compared_title(s).alias("n"))))
    alike = lambda a, b: (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    pairs = F.exists("__norms", lambda x: F.exists("__norms", lambda y: (y["i"] > x["i"]) & alike(x["n"], y["n"])))
    df = df.withColumn("__similar", pairs & (F.col("__size") >= 2))
    named = F.coalesce(F.get(F.filter("__block", heading), F.lit(0)), F.concat(F.lit("# "), F.get(F.col("__block"), F.lit(0))))
    df = df.withColumn("__title", F.concat(F.lit("# "), T.strip(F.regexp_replace(named, r"(?U)\A#{1,6}\s+", ""))))
    df = df.withColumn("__key", T.compared_title(F.col("__title")))
    raw = F.slice("__lines", F.lit(1), F.greatest("__size", F.lit(0)))
    tail = F.filter(raw, lambda x: ~((T.compared_title(x) == F.col("__key")) | alike(T.compared_title(x), F.col("__key"))))
    df = df.withColumn("__tail", tail).withColumn("__after", F.slice("__lines", F.col("__size") + 1, F.size("__lines")))
    folded = T.lstrip_newlines(F.array_join(F.concat(F.array("__title"), "__tail", "__after"), "\n"))
    out = F.when(F.col("__first").isNull(), F.col(text)).when(F.col("__similar"), F.concat("__head", folded)).otherwise(F.concat("__head", F.array_join("__lines", "\n")))
    return df.withColumn(text, out).drop(*[f"__{c}" for c in "head body all first lines opening size block norms similar title key tail after".split()])


def link_bare_files(df: DataFrame, text: str) -> DataFrame:
    """Lines that are only an attachment address become an image or a list link."""

    def line(x: Column) -> Column:
        st = T.strip(x)
        bare = st.rlike(rf"(?iU)\A{_FILE_URL}\z")
        last = F.substring_index(T.url_path(st), "/", -1)
        name = F.coalesce(T.filled(F.substring_index(T.percent_decoded(last), "?", 1)), st)
        image = st.rlike(rf"(?iU)\A{_FILE_URL}\.(?:png|jpe?g|gif|webp|svg)(?:\?[^)\s\"']*)?\z") | st.rlike(r"(?i)image\d|thumbnail")
        link = F.concat(F.when(image, "![").otherwise("* ["), name, F.lit("]("), st, F.lit(")\n"))
        return F.when(bare & F.contains(st, F.lit("download/attachments")), link).otherwise(x)

    changed = F.array_join(F.transform(T.lines_with_ends(F.col(text)), line), "")
    return df.withColumn(text, F.when(F.contains(F.lower(F.col(text)), F.lit("/download/attachments/")), changed).otherwise(F.col(text)))


def squeeze(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn(text, T.squeezed_keeping_crlf(F.col(text)))


def clean_pages(df: DataFrame, raw: str, out: str = "cleaned", error: str | None = None) -> DataFrame:
    """The whole chain from ``raw`` to ``out``; also adds ``author`` and ``last_modified``, and ``error`` if asked for. Null and blank texts come out as their front matter alone."""
    df = df.withColumn("__raw", F.coalesce(F.col(raw), F.lit("")))
    df = attachments_index(df, "__raw", "__index").withColumn(out, F.col("__raw")).drop("__raw")
    df = cut_head(take_metadata(df, out, error=error), out).withColumn(out, F.concat("__index", out)).drop("__index")
    for step in (prepend_front_matter, cut_tail, clean_ui, clean_anchors, dedupe_titles, link_bare_files, squeeze):
        df = step(df, out)
    return df.withColumn(out, F.concat(T.rstrip(F.col(out)), F.lit("\n")))


def clean_totals(df: DataFrame, raw: str, cleaned: str) -> DataFrame:
    """One row: pages, pages changed, characters before and after."""
    return df.agg(
        F.count("*").alias("pages"), F.count_if(~F.col(raw).eqNullSafe(F.col(cleaned))).alias("changed"),
        F.coalesce(F.sum(F.length(raw)), F.lit(0)).alias("chars_before"), F.coalesce(F.sum(F.length(cleaned)), F.lit(0)).alias("chars_after"),
    )
