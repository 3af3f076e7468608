"""Queries of the string, path and URL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.conversion import converter_text
from leafmill.operators.ranking import distinct_texts
from leafmill.operators.runs import fetch_fallback
from leafmill.operators.trees import distinct_nodes
from leafmill.plans import sqlkit as Q
from leafmill.session import table


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_nodes(table(spark, folder, "page_nodes"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with Markdown, once each."""
    rows = table(spark, folder, "fetch_attempts").where(F.col("markdown").rlike(r"(?U)[^\s\x1c-\x1f]"))
    return distinct_texts(rows.select("page_id", "tree_id", "markdown"), ["page_id", "tree_id"], "markdown")


def wrapped(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", "tree_id", F.expr(Q.WRAPPED).alias("raw"))


def slug_titles(spark, folder):
    return nodes(spark, folder).select("tree_id", "id", T.file_name(F.col("title")).alias("slug"))


def folder_segments(spark, folder):
    return nodes(spark, folder).select("tree_id", "id", T.folder_segment(F.col("slug"), F.col("title"), F.col("id")).alias("segment"))


def plain_titles(spark, folder):
    rows = table(spark, folder, "fetch_attempts").select("title").distinct()
    return rows.select("title", T.plain_title(F.col("title"), "wiki").alias("plain"))


def page_stems(spark, folder):
    got = fetch_fallback(table(spark, folder, "fetch_attempts")).select("tree_id", F.col("page_id").alias("id"), F.col("title").alias("fetched"))
    rows = nodes(spark, folder).join(got, ["tree_id", "id"], "left")
    stem = T.page_stem(F.col("title"), F.col("fetched"), F.col("slug"), F.col("id"), "wiki")
    return rows.select("tree_id", "id", T.page_path(F.col("tree_id"), stem).alias("path"))


def attachment_names(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.attachment_name(F.col("title")).alias("name"), T.attachment_name(F.col("text")).alias("from_text"))


def _links(spark, folder):
    found = F.explode(F.regexp_extract_all("raw", F.lit(r"(https?://[^)\s\"']+)"), F.lit(1)))
    return wrapped(spark, folder).select(found.alias("url")).distinct()


def url_file_names(spark, folder):
    name = T.url_file_name(F.col("url"))
    return _links(spark, folder).select("url", name.alias("name"), T.collision_name(F.col("url"), name).alias("collision_name"))


def download_urls(spark, folder):
    link = F.expr("CASE pos % 4 WHEN 0 THEN concat('/download/', id) WHEN 1 THEN concat('x/', id) WHEN 2 THEN concat('HTTP://h.example.com/', id) ELSE '  ' END")
    rows = nodes(spark, folder).join(F.broadcast(table(spark, folder, "page_trees").select("tree_id", "base_url").distinct()), "tree_id")  # one row per site
    return rows.select("tree_id", "id", T.download_url(F.concat("base_url", F.lit("/")), link).alias("url"))


def site_bases(spark, folder):
    rows = wrapped(spark, folder)
    return rows.select("page_id", F.array_join(F.array_sort(T.site_bases(F.col("raw"), "http://wiki.example.com")), " ").alias("bases"))


def link_page_ids(spark, folder):
    return wrapped(spark, folder).select("page_id", F.array_join(T.page_ids(F.col("raw")), " ").alias("ids"))


def direct_attachments(spark, folder):
    return wrapped(spark, folder).select("page_id", F.array_join(T.attachment_urls(F.col("raw")), " ").alias("urls"))


def compared_titles(spark, folder):
    return nodes(spark, folder).select("tree_id", "id", T.compared_title(F.concat(F.lit("##  "), F.coalesce("title", F.lit("")), F.lit(" "))).alias("compared"))


def yaml_scalars(spark, folder):
    rows = table(spark, folder, "page_meta").select("author").distinct()
    return rows.select("author", T.yaml_scalar(F.col("author")).alias("scalar"), T.yaml_quoted(F.col("author")).alias("quoted"))


def blank_runs(spark, folder):
    runs = F.expr("replace(text, chr(10), repeat(chr(10), CAST(doc_id % 4 + 1 AS INT)))")
    rows = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", runs.alias("t"))
    return rows.select("doc_id", F.md5(T.squeezed_keeping_crlf(F.col("t")).cast("binary")).alias("keeping_crlf"), F.md5(T.squeezed(F.col("t")).cast("binary")).alias("normalised"))


def next_starts(spark, folder):
    link = F.expr("CASE pos % 4 WHEN 0 THEN concat('/rest?limit=50&start=', pos * 7) WHEN 1 THEN '/rest?limit=50' WHEN 2 THEN '/rest?start=x' ELSE NULL END")
    return nodes(spark, folder).select("tree_id", "id", T.next_start(link, F.col("pos") * 50, F.lit(50)).alias("next_start"))


def markdown_paths(spark, folder):
    rows = table(spark, folder, "conversion_results").select("source_file").distinct()
    return rows.select("source_file", T.markdown_path(F.col("source_file")).alias("markdown_path"), T.extension(F.col("source_file")).alias("ext"))


def viewing_urls(spark, folder):
    rows = nodes(spark, folder).join(F.broadcast(table(spark, folder, "page_trees").select("tree_id", "base_url").distinct()), "tree_id")  # one row per site
    return rows.select("tree_id", "id", T.viewing_url(F.col("base_url"), F.col("id")).alias("url"))


def settings(spark, folder):
    return table(spark, folder, "page_meta").dropDuplicates(["meta_id"]).select("meta_id", T.setting(F.col("author"), F.col("last_modified"), default="none").alias("value"))


def converter_texts(spark, folder):
    rows = table(spark, folder, "documents")
    return rows.select("doc_id", F.md5(converter_text(F.col("title"), F.col("text"), F.col("lang"), F.col("source")).cast("binary")).alias("text_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        slug_titles, folder_segments, plain_titles, page_stems, attachment_names, url_file_names, download_urls, site_bases, link_page_ids, direct_attachments, compared_titles, yaml_scalars, blank_runs, next_starts, markdown_paths, viewing_urls, settings, converter_texts
    )
}

_W = f"(SELECT page_id, tree_id, {Q.WRAPPED} AS raw FROM {Q.PAGES})"
_SEGMENT = f"CASE WHEN {Q.strip(chr(39) * 2 + ' || coalesce(slug, ' + chr(39) * 2 + ')')} <> '' THEN {Q.file_name('slug')} ELSE {Q.file_name('coalesce(nullif(title, ' + chr(39) * 2 + '), ' + chr(39) + 'page_' + chr(39) + ' || id)')} END"
_PLAIN_PATTERN = rf"(?i)\A(.+?){Q.WS}+-{Q.WS}+.+{Q.WS}+-{Q.WS}*wiki{Q.WS}*\z"
_STRIPPED = Q.strip("coalesce(title, '')")
_PLAIN = "coalesce(nullif(" + Q.strip(f"regexp_extract({_STRIPPED}, '{_PLAIN_PATTERN}', 1)") + f", ''), {_STRIPPED})"
_QUOTED = "concat('\"', replace(replace(coalesce({x}, ''), chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), '\"')"
_NAME = "CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) LIKE '%/' OR regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN 'attachment.bin' ELSE " + Q.strip(
    "regexp_replace(url_decode(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')[-1]), '[<>:\"/\\\\|?*]', '_', 'g')"
) + " END"

ORACLES = {
    "slug_titles": f"SELECT tree_id, id, {Q.file_name('title')} AS slug FROM {Q.NODES}",
    "folder_segments": f"SELECT tree_id, id, {_SEGMENT} AS segment FROM {Q.NODES}",
    "plain_titles": f"SELECT title, {_PLAIN} AS plain FROM (SELECT DISTINCT title FROM fetch_attempts)",
    "page_stems": f"""SELECT tree_id, id, concat(tree_id, '/', CASE WHEN {_STRIPPED} <> '' THEN {Q.file_name(_STRIPPED)} WHEN plain <> '' THEN {Q.file_name('plain')} ELSE {_SEGMENT} END, '.md') AS path
      FROM {Q.NODES} LEFT JOIN (SELECT tree_id, page_id AS id, {_PLAIN} AS plain FROM {Q.FALLBACK}) USING (tree_id, id)""",
    "attachment_names": f"""SELECT doc_id, substr(coalesce(nullif({Q.strip("regexp_replace(coalesce(title, ''), '[<>:" + chr(34) + "/" + chr(92) * 2 + "|?*]', '_', 'g')")}, ''), 'attachment'), 1, 180) AS name,
      substr(coalesce(nullif({Q.strip("regexp_replace(coalesce(text, ''), '[<>:" + chr(34) + "/" + chr(92) * 2 + "|?*]', '_', 'g')")}, ''), 'attachment'), 1, 180) AS from_text FROM documents""",
    "url_file_names": f"""SELECT url, name, concat(substr(md5(url), 1, 8), '_', name) AS collision_name FROM (SELECT url, {_NAME} AS name FROM (SELECT DISTINCT unnest(regexp_extract_all(raw, '(https?://[^)\\s"'']+)', 1)) AS url FROM {_W}))""",
    "download_urls": f"""SELECT tree_id, id, CASE pos % 4 WHEN 0 THEN base_url || '/download/' || id WHEN 1 THEN base_url || '/x/' || id WHEN 2 THEN 'HTTP://h.example.com/' || id ELSE '' END AS url
      FROM {Q.NODES} JOIN (SELECT DISTINCT tree_id, base_url FROM page_trees) USING (tree_id)""",
    "site_bases": f"""WITH b AS (SELECT page_id, unnest(list_concat(regexp_extract_all(raw, '(?i)(https?://[^{Q.WSC}"''`()<>\\]]+)/pages/', 1), regexp_extract_all(raw, '(?i)(https?://[^{Q.WSC}"''`()<>\\]]+)/download/attachments/', 1))) AS base FROM {_W}),
      g AS (SELECT page_id, string_agg(DISTINCT rtrim(base, '/'), ' ' ORDER BY rtrim(base, '/')) AS bases FROM b GROUP BY page_id)
      SELECT page_id, coalesce(bases, nullif(rtrim(regexp_extract(raw, '(?i)(https?://[a-z0-9.:-]+)/', 1), '/'), ''), 'http://wiki.example.com') AS bases FROM {_W} LEFT JOIN g USING (page_id)""",
    "link_page_ids": f"""SELECT page_id, coalesce(ids, '') AS ids FROM {_W} LEFT JOIN (SELECT page_id, string_agg(i, ' ' ORDER BY CAST(i AS HUGEINT)) AS ids
      FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(raw, '(?i)[?&]pageId=([0-9]+)', 1)) AS i FROM {_W}) GROUP BY page_id) USING (page_id)""",
    "direct_attachments": f"""SELECT page_id, coalesce(urls, '') AS urls FROM {_W} LEFT JOIN (SELECT page_id, string_agg(u, ' ' ORDER BY u) AS urls
      FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(raw, '(?i)(https?://[^){Q.WSC}"'']+/download/attachments/[^){Q.WSC}"'']+)', 1)) AS u FROM {_W}) GROUP BY page_id) USING (page_id)""",
    "compared_titles": f"SELECT tree_id, id, lower(regexp_replace(regexp_replace({Q.strip(f'''concat('##  ', coalesce(title, ''), ' ')''')}, '\\A#{{1,6}}{Q.WS}+', ''), '{Q.WS}+', ' ', 'g')) AS compared FROM {Q.NODES}",
    "yaml_scalars": f"""SELECT author, CASE WHEN coalesce(author, '') = '' THEN '""' WHEN regexp_matches(author, '[\\n:#{{}}\\[\\]&*!|>'',"]') OR {Q.strip('author')} <> author THEN {_QUOTED.format(x='author')} ELSE author END AS scalar,
      {_QUOTED.format(x='author')} AS quoted FROM (SELECT DISTINCT author FROM page_meta)""",
    "blank_runs": r"""SELECT doc_id, md5(regexp_replace(t, '(?:\r?\n){3,}', chr(10) || chr(10), 'g')) AS keeping_crlf, md5(regexp_replace(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n{3,}', chr(10) || chr(10), 'g')) AS normalised
      FROM (SELECT doc_id, replace(text, chr(10), repeat(chr(10), CAST(doc_id % 4 + 1 AS INT))) AS t FROM documents WHERE text IS NOT NULL)""",
    "next_starts": f"SELECT tree_id, id, CAST(CASE pos % 4 WHEN 0 THEN pos * 7 WHEN 1 THEN pos * 50 + 50 WHEN 2 THEN pos * 50 + 50 ELSE NULL END AS INTEGER) AS next_start FROM {Q.NODES}",
    "markdown_paths": r"SELECT source_file, concat(regexp_replace(source_file, '([^/])\.[^./]+\z', '\1'), '.md') AS markdown_path, lower(regexp_extract(source_file, '[^/](\.[^./]+)\z', 1)) AS ext FROM (SELECT DISTINCT source_file FROM conversion_results)",
    "viewing_urls": f"SELECT tree_id, id, base_url || '/pages/viewpage.action?pageId=' || id AS url FROM {Q.NODES} JOIN (SELECT DISTINCT tree_id, base_url FROM page_trees) USING (tree_id)",
    "settings": f"SELECT meta_id, coalesce(nullif({Q.strip('author')}, ''), nullif({Q.strip('last_modified')}, ''), 'none') AS value FROM (SELECT DISTINCT meta_id, author, last_modified FROM page_meta)",
    "converter_texts": f"SELECT doc_id, md5(CASE WHEN {Q.strip('title')} <> '' THEN title WHEN {Q.strip('text')} <> '' THEN text WHEN {Q.strip('lang')} <> '' THEN lang WHEN {Q.strip('source')} <> '' THEN source ELSE '' END) AS text_md5 FROM documents",
}
