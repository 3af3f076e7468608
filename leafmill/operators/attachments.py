"""Attachment planning: which files to fetch for a page's text, from where and under which name. Fetching itself is a connector's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.session import cut

GENERIC = ["attachment.bin", "attachment", "file"]


def text_links(docs: DataFrame, doc: str, raw: str, cleaned: str | None = None, default_site: str = "") -> DataFrame:
    """(doc, ids, sites, urls): the page ids, sites and direct attachment links of each document. Raw and cleaned text count both. Stored, so that each text is read once."""
    blob = F.concat_ws("\n", F.col(raw), F.col(cleaned)) if cleaned else F.coalesce(F.col(raw), F.lit(""))
    rows = docs.select(F.col(doc).alias("doc"), blob.alias("b"))
    rows = rows.select("doc", T.page_ids(F.col("b")).alias("ids"), T.site_bases(F.col("b"), default_site).alias("sites"), T.attachment_urls(F.col("b")).alias("urls"))
    return cut(rows.where((F.size("ids") > 0) | (F.size("urls") > 0)))


def page_sites(links: DataFrame) -> DataFrame:
    """(doc, page_id, site, site_order): the page ids of each document of :func:`text_links` with the sites to try, in order."""
    rows = links
    return rows.select("doc", F.explode("ids").alias("page_id"), "sites").select("doc", "page_id", F.posexplode("sites").alias("site_order", "site"))


def rest_choice(sites: DataFrame, listings: DataFrame) -> DataFrame:
    """Of each document's page the attachments of the first site that lists any. ``listings``: site, page_id, att_id, title, download."""
    has = listings.select("site", "page_id").distinct()
    first = sites.join(has, ["site", "page_id"]).groupBy("doc", "page_id").agg(F.min_by("site", "site_order").alias("site"))
    return first.join(listings, ["site", "page_id"]).select("doc", "page_id", "site", "att_id", "title", "download")


def attachment_plan(docs: DataFrame, doc: str, raw: str, listings: DataFrame, cleaned: str | None = None, default_site: str = "") -> DataFrame:
    """(doc, url, source, file_name): REST links before direct ones, each URL once per document; names as stated for each source.

    Of direct links that share a name in a document, the first by URL keeps it, later ones get the URL's hash before it. Empty links are left out.
    """
    links = text_links(docs, doc, raw, cleaned, default_site)
    rest = rest_choice(page_sites(links), listings)
    rest = rest.withColumn("url", T.download_url(F.col("site"), F.col("download"))).where("url <> ''")
    title = F.coalesce(T.filled(T.strip(F.coalesce("title", F.lit("")))), T.url_file_name(F.col("url")))
    name = T.attachment_name(T.percent_decoded(F.substring_index(title, "?", 1)))
    named = F.when(F.coalesce("att_id", F.lit("")) == "", name).otherwise(F.concat(F.substring("att_id", 1, 20), F.lit("_"), name))
    rest = rest.select("doc", "url", F.lit("rest").alias("source"), named.alias("file_name"), F.struct("page_id", "att_id").alias("o"))
    rest = rest.groupBy("doc", "url").agg(F.first("source").alias("source"), F.min_by("file_name", "o").alias("file_name"))
    direct = links.select("doc", F.explode("urls").alias("url")).distinct()
    direct = direct.join(rest.select("doc", "url"), ["doc", "url"], "left_anti")
    plain = T.url_file_name(F.col("url"))
    direct = direct.withColumn("n", F.when(plain.isin(GENERIC), "file.bin").otherwise(plain))
    place = F.row_number().over(Window.partitionBy("doc", "n").orderBy("url"))  # bounded by one document's links
    direct = direct.withColumn("k", place).select("doc", "url", F.lit("direct").alias("source"), F.when(F.col("k") == 1, F.col("n")).otherwise(T.collision_name(F.col("url"), F.col("n"))).alias("file_name"))
    return rest.unionByName(direct)


def fetch_totals(fetched: DataFrame) -> DataFrame:
    """(doc, success, failed): a non-empty file that exists already counts as a success. ``fetched``: doc, url, ok."""
    return fetched.groupBy("doc").agg(F.count_if("ok").alias("success"), F.count_if(~F.col("ok")).alias("failed"))
