"""Queries of the page-cleaning steps, HTML conversion and conversion text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators import attachments as A
from leafmill.operators import cleaning as C
from leafmill.operators import conversion as V
from leafmill.operators import html as H
from leafmill.operators import trees
from leafmill.plans import sqlkit as Q
from leafmill.plans.scalars import pages, wrapped
from leafmill.session import table

#: One expression for both engines: a small HTML page from a node's title and slug.
HTML = """concat('<html><head><title>', coalesce(title, ''), '</title></head><body><h1>Page ', id, '</h1><p>See <a href="/x/', id, '">here</a> and <img src="/i/', id, '.png"> or <a href="http://o.example.com/">other</a>.</p>',
  CASE WHEN pos % 2 = 0 THEN '<table><tr><th colspan="2">A</th></tr><tr><td>1</td><td>2</td></tr></table>' ELSE '<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>' END,
  '<ul><li>one<ul><li>two</li></ul></li></ul></body></html>')"""


def _step(name: str, *steps, source=pages):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = source(spark, folder)
        text = "raw" if "raw" in df.columns else "markdown"
        for step in steps:
            df = step(df, text)
        return df.select("page_id", F.md5(F.col(text).cast("binary")).alias("text_md5"), F.length(text).alias("chars"))

    query.__name__ = name
    return query


def attachments_index(spark, folder):
    return C.attachments_index(pages(spark, folder), "markdown").select("page_id", "attachments_index")


def bylines(spark, folder):
    out = C.take_metadata(pages(spark, folder), "markdown")
    return out.select("page_id", "author", "last_modified", F.length("markdown").alias("chars"))


def front_matter(spark, folder):
    rows = table(spark, folder, "page_meta").select("meta_id", F.coalesce("author", F.lit("")).alias("author"), F.coalesce("last_modified", F.lit("")).alias("last_modified")).distinct()
    rows = rows.withColumn("t", F.concat(F.lit("\n\n# "), "meta_id"))
    return C.prepend_front_matter(rows, "t").select("meta_id", F.col("t").alias("document"))


def clean_full(spark, folder):
    return C.clean_pages(pages(spark, folder), "markdown").select("page_id", "tree_id", "author", "last_modified", "cleaned")


def clean_totals(spark, folder):
    return C.clean_totals(C.clean_pages(wrapped(spark, folder), "raw"), "raw", "cleaned")


def table_lines(spark, folder):
    rows = table(spark, folder, "documents").where("text IS NOT NULL")
    return rows.select("doc_id", F.md5(V.table_lines(F.col("text")).cast("binary")).alias("text_md5"))


def conversion_clean(spark, folder):
    rows = table(spark, folder, "documents").where("text IS NOT NULL").withColumn("model", F.lit("vision-s"))
    out = V.cleaned_conversion(rows, "text", "title", "file_type", "model", "2025-01-01 00:00:00")
    return out.select("doc_id", F.md5(F.col("markdown").cast("binary")).alias("text_md5"))


def _html(spark, folder):
    nodes = trees.distinct_nodes(table(spark, folder, "page_nodes"))
    rows = nodes.select("tree_id", "id", F.expr(HTML).alias("html"))
    sites = table(spark, folder, "page_trees").select("tree_id", "base_url").distinct()
    return rows.join(F.broadcast(sites), "tree_id")  # one row per site


def html_links(spark, folder):
    return _html(spark, folder).select("tree_id", "id", H.absolute_links(F.col("html"), F.col("base_url")).alias("html"))


def html_titles(spark, folder):
    return _html(spark, folder).select("tree_id", "id", H.page_title(F.col("html"), F.col("id")).alias("title"))


def html_markdown(spark, folder):
    return _html(spark, folder).select("tree_id", "id", H.html_to_markdown(F.col("html"), F.col("base_url")).alias("markdown"))


def _listings(spark, folder):
    nodes = trees.distinct_nodes(table(spark, folder, "page_nodes")).where("id IS NOT NULL")
    name = F.expr("concat('/download/attachments/', id, '/', CASE pos % 3 WHEN 0 THEN 'image1.png' WHEN 1 THEN 'notes%20a.pdf' ELSE 'x' END)")
    return nodes.select(F.lit("http://wiki.example.com").alias("site"), F.col("id").alias("page_id"), F.expr("CASE WHEN pos % 2 = 0 THEN concat('att', id) ELSE '' END").alias("att_id"), F.expr("CASE WHEN pos % 5 = 0 THEN '' ELSE 'a plan: v1' END").alias("title"), name.alias("download"))


def attachment_plan(spark, folder):
    return A.attachment_plan(wrapped(spark, folder), "page_id", "raw", _listings(spark, folder)).select(F.col("doc").alias("page_id"), "url", "source", "file_name")


cut_head = _step("cut_head", C.cut_head)
cut_tail = _step("cut_tail", C.cut_tail)
tree_sidebar = _step("tree_sidebar", C.remove_tree_sidebar)
buttons = _step("buttons", C.remove_buttons, source=wrapped)
anchors = _step("anchors", C.remove_anchors, source=wrapped)
avatars = _step("avatars", C.remove_avatars, source=wrapped)
hash_links = _step("hash_links", C.remove_hash_links, source=wrapped)
breadcrumbs = _step("breadcrumbs", C.remove_breadcrumb, source=wrapped)
bare_links = _step("bare_links", C.link_bare_files, source=wrapped)
navigation = _step("navigation", C.remove_navigation)
ui_noise = _step("ui_noise", C.clean_ui, source=wrapped)
title_dedupe = _step("title_dedupe", C.cut_head, C.dedupe_titles)

QUERIES = {
    f.__name__: f
    for f in (
        attachments_index, bylines, front_matter, clean_full, clean_totals, table_lines, conversion_clean, html_links, html_titles, html_markdown, attachment_plan, cut_head, cut_tail, tree_sidebar, buttons, anchors, avatars, hash_links, breadcrumbs, bare_links, navigation, ui_noise, title_dedupe
    )
}

_W = f"(SELECT page_id, tree_id, {Q.WRAPPED} AS raw FROM {Q.PAGES})"
_HTML = f"(SELECT tree_id, id, base_url, {HTML} AS html, title FROM {Q.NODES} JOIN (SELECT DISTINCT tree_id, base_url FROM page_trees) USING (tree_id))"
_OUT = "SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS chars FROM "
_MARKERS = ["'## 评论'", "'无标签'", "'写评论...'", "concat('概览', chr(10), chr(10), '内容工具')", "'基于 Atlassian Confluence'", "'{\"serverDuration\":'", "concat('search', chr(10), chr(10), 'recentlyviewed')", "'更新恢复页面保留草稿取消'"]
_FIRST = "least(" + ", ".join(f"nullif(strpos(markdown, {m}), 0)" for m in _MARKERS) + ")"
_HEAD = rf"(?m)^{Q.WS}*\[转至元数据起始\]{Q.WS}*\([^)]*\){Q.WS}*"
_FILE = rf"https?://[^){Q.WSC}\"'']+/download/attachments/[^/]+/[^){Q.WSC}\"'']+"
_FILE = _FILE.replace('\\"', '"')
_SCALAR = "CASE WHEN {x} = '' THEN '\"\"' WHEN regexp_matches({x}, '[\\n:#{{}}\\[\\]&*!|>'',\"]') OR " + Q.strip("{x}") + " <> {x} THEN concat('\"', replace(replace({x}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), '\"') ELSE {x} END"
_CELLS = f"list_transform(string_split(regexp_replace(regexp_replace({Q.strip('l')}, '\\A[|]+', ''), '[|]+\\z', ''), '|'), lambda c: {Q.strip('c')})"
_RULE = rf"len(list_filter({_CELLS}, lambda c: NOT regexp_matches(c, '\A[:\-{Q.WSC}]+\z'))) = 0"
_LINE = f"CASE WHEN contains(l, '|') AND NOT starts_with({Q.strip('l')}, '```') THEN concat('| ', array_to_string(CASE WHEN {_RULE} THEN list_transform({_CELLS}, lambda c: replace(c, ' ', '')) ELSE {_CELLS} END, ' | '), ' |') ELSE {Q.rstrip('l')} END"

_TITLE = Q.strip("coalesce(title, '')")


def _table_sql(x: str) -> str:
    return f"array_to_string(list_transform({Q.lines(x)}, lambda l: {_LINE}), chr(10))"


def _squeeze_sql(x: str) -> str:
    return f"regexp_replace(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')"


ORACLES = {
    "attachments_index": rf"""WITH u AS (SELECT page_id, markdown, unnest(list_distinct(regexp_extract_all(markdown, '(?i)https?://[^){Q.WSC}"'']+/pages/viewpageattachments\.action\?pageId=[0-9]+'))) AS url FROM {Q.PAGES}),
      c AS (SELECT page_id, url, pos, regexp_extract_all(substr(markdown, greatest(pos - 220, 1), least(pos - 1, 220)), '(?i)附件[（(][0-9]+[）)]|\[t[（(][0-9]+[）)]\]|t[（(][0-9]+[）)]{Q.WS}*附件|t附件[（(][0-9]+[）)]') AS m FROM (SELECT *, strpos(markdown, url) AS pos FROM u)),
      g AS (SELECT page_id, concat('## 附件与文件', chr(10), string_agg(concat('* [附件与文件管理（', CASE WHEN len(m) > 0 THEN concat('共 ', regexp_extract(m[-1], '[0-9]+'), ' 个') ELSE '本页' END, '）](', url, ')'), chr(10) ORDER BY pos), chr(10), chr(10)) AS t FROM c GROUP BY page_id)
      SELECT page_id, coalesce(t, '') AS attachments_index FROM {Q.PAGES} LEFT JOIN g USING (page_id)""",
    "front_matter": f"""SELECT DISTINCT meta_id, concat('---', chr(10), 'author: ', {_SCALAR.replace('{x}', 'a').replace('{{', '{').replace('}}', '}')}, chr(10), 'last_modified: ', {_SCALAR.replace('{x}', 'm').replace('{{', '{').replace('}}', '}')}, chr(10), '---', chr(10), chr(10), '# ', meta_id) AS document
      FROM (SELECT meta_id, coalesce(author, '') AS a, coalesce(last_modified, '') AS m FROM page_meta)""",
    "cut_head": _OUT + rf"(SELECT page_id, CASE WHEN regexp_matches(markdown, '{_HEAD}') THEN regexp_replace(substr(markdown, strpos(markdown, regexp_extract(markdown, '{_HEAD}')) + length(regexp_extract(markdown, '{_HEAD}'))), '\A\n+', '') ELSE markdown END AS t FROM {Q.PAGES})",
    "cut_tail": _OUT + f"""(SELECT page_id, CASE WHEN pos IS NULL THEN markdown WHEN k = '' THEN '' ELSE k || chr(10) END AS t FROM (SELECT *, {Q.rstrip("CASE WHEN contains(b, chr(10)) THEN left(b, length(b) - strpos(reverse(b), chr(10)) + 1) ELSE '' END")} AS k
      FROM (SELECT *, left(markdown, pos - 1) AS b FROM (SELECT *, {_FIRST} AS pos FROM {Q.PAGES}))))""",
    "tree_sidebar": _OUT + rf"""(SELECT page_id, CASE WHEN pos = 0 THEN markdown WHEN e IS NULL THEN {Q.rstrip('left(markdown, pos - 1)')} || chr(10) ELSE left(markdown, pos - 1) || substr(rest, e) END AS t FROM (SELECT *, least(
      CASE WHEN contains(rest, '重排页面') THEN strpos(rest, '重排页面') + length(regexp_extract(substr(rest, strpos(rest, '重排页面')), '\A[^\n]*')) END,
      CASE WHEN regexp_matches(rest, '(?m)^#{Q.WS}+[^\n]+$') THEN length(regexp_extract(rest, '(?ms)\A(.*?)^#{Q.WS}+[^\n]+$', 1)) + 1 END) AS e
      FROM (SELECT *, strpos(markdown, '##### 页面树结构') AS pos, substr(markdown, strpos(markdown, '##### 页面树结构')) AS rest FROM {Q.PAGES})))""",
    "buttons": _OUT + rf"(SELECT page_id, regexp_replace(raw, '(?m)^{Q.WS}*[*+]{Q.WS}*\[(?:E编辑|F收藏|S分享|导出为PDF|Doc文件导入)\][^\n]*{Q.WS}*$', '', 'g') AS t FROM {_W})",
    "anchors": _OUT + rf"(SELECT page_id, regexp_replace(raw, '\[(?:跳到banner的尾部|回到标题开始|转至元数据结尾|转至元数据起始)\]\([^)]*\)', '', 'g') AS t FROM {_W})",
    "avatars": _OUT + rf"(SELECT page_id, regexp_replace(raw, '\[!\[用户图标:{Q.WS}*添加头像\]\([^)]*\)\]\([^)]*\){Q.WS}*', '', 'g') AS t FROM {_W})",
    "hash_links": _OUT + rf"(SELECT page_id, regexp_replace(raw, '(?m)^{Q.WS}*[*+-]{Q.WS}*\[[^\]]+\]\(#\){Q.WS}*$', '', 'g') AS t FROM {_W})",
    "breadcrumbs": _OUT + rf"(SELECT page_id, regexp_replace(raw, '(?m)\A\n*(?:[0-9]+\.{Q.WS}+\[[^\]]+\]\([^)]*\){Q.WS}*(?:\r?\n|$))+\n*', '') AS t FROM {_W})",
    "bare_links": _OUT + rf"""(SELECT page_id, string_agg(o, '' ORDER BY k) AS t FROM (SELECT page_id, k, CASE WHEN regexp_matches(s, '(?i)\A{_FILE}\z') THEN concat(CASE WHEN regexp_matches(s, '(?i)\.(?:png|jpe?g|gif|webp|svg)\z|image[0-9]|thumbnail') THEN '![' ELSE '* [' END, url_decode(string_split(s, '/')[-1]), '](', s, ')', chr(10)) ELSE l END AS o
      FROM (SELECT *, {Q.strip('l')} AS s FROM (SELECT page_id, unnest(a) AS l, generate_subscripts(a, 1) AS k FROM (SELECT page_id, regexp_extract_all(raw, '[^\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]*(?:{Q.ENDS})|[^\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]+\z') AS a FROM {_W})))) GROUP BY page_id)""",
    "table_lines": f"SELECT doc_id, md5({_table_sql('text')}) AS text_md5 FROM documents WHERE text IS NOT NULL",
    "conversion_clean": f"""SELECT doc_id, md5({Q.rstrip('d')} || chr(10)) AS text_md5 FROM (SELECT doc_id, concat('---', chr(10), 'source_file: "', replace(replace(coalesce(title, ''), chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), '"', chr(10), 'file_type: "', file_type, '"', chr(10),
      'conversion_date: "2025-01-01 00:00:00"', chr(10), 'used_llm_model: "vision-s"', chr(10), '---', chr(10), chr(10), regexp_replace(regexp_replace({_squeeze_sql('b')}, '\\A\\x{{FEFF}}+', ''), '\\A\\n+', '')) AS d FROM (SELECT *, {_table_sql('q')} AS b FROM (SELECT *, {_squeeze_sql('text')} AS q FROM documents WHERE text IS NOT NULL)))""",
    "html_links": f"""SELECT tree_id, id, replace(replace(html, 'href="/', concat('href="', base_url, '/')), 'src="/', concat('src="', base_url, '/')) AS html FROM {_HTML}""",
    "html_titles": f"SELECT tree_id, id, coalesce(nullif({_TITLE}, ''), 'page_' || id) AS title FROM {_HTML}",
}
