"""Queries of file conversion, status reports, retrieval and event counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import attachments as A
from leafmill.operators import conversion as V
from leafmill.operators import retrieval as G
from leafmill.plans import sqlkit as Q
from leafmill.plans.scalars import wrapped
from leafmill.session import table
from leafmill.streaming.incremental import status_counts

#: Both engines: pieces of streamed answers, from events.
CHUNKS = "SELECT user_id AS stream_id, event_id AS seq, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS content, CASE WHEN event_id % 3 = 0 THEN props END AS reasoning FROM {events}"


def _files(spark, folder):
    return table(spark, folder, "conversion_results").select("source_file").distinct()


def route_files(spark, folder):
    return V.routed(_files(spark, folder), "source_file")


def round_robin(spark, folder):
    return V.assigned(V.routed(_files(spark, folder), "source_file"), "source_file").select("source_file", "model")


def path_collisions(spark, folder):
    return V.output_collisions(_files(spark, folder), "source_file")


def _results(spark, folder):
    return table(spark, folder, "conversion_results").distinct()


def status_summary(spark, folder):
    rows = _results(spark, folder).withColumn("tree", F.substring_index("source_file", "/", 1))
    return V.status_summary(rows, ["tree"])


def status_total(spark, folder):
    return V.status_summary(_results(spark, folder))


def failure_log(spark, folder):
    return V.failure_log(_results(spark, folder))


def stream_chunks(spark, folder):
    return V.joined_chunks(spark.sql(CHUNKS.replace("{events}", "{e}"), e=table(spark, folder, "events")))


def window_counts(spark, folder):
    return status_counts(table(spark, folder, "events"), "ts", "event_type")


def plain_items(spark, folder):
    rows = G.plain_items(table(spark, folder, "documents"), "doc_id", "text", "file_type")
    return rows.select("doc", F.explode("items").alias("i")).select("doc", "i.type", F.md5(F.col("i.text").cast("binary")).alias("text_md5"), "i.page_idx")


def ingestible(spark, folder):
    return G.ingestible(table(spark, folder, "documents"), "file_type").select("doc_id", "file_type")


def text_chunks(spark, folder):
    rows = G.chunks(table(spark, folder, "documents"), "doc_id", "text")
    return rows.select("doc", "chunk_no", F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"))


def questions(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", F.expr("CASE WHEN doc_id = 700 THEN ' QUIT ' ELSE title END").alias("line"))
    return G.questions(rows, "doc_id", "line")


def _queries(spark, folder):
    vectors = table(spark, folder, "embeddings").where("vec_id % 50 = 0")
    return vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def vector_topk(spark, folder):
    top = G.cosine_top_k(table(spark, folder, "embeddings"), "vec_id", "embedding", _queries(spark, folder))
    return top.select("query_id", "vec_id", F.round("score", 4).alias("score"), "rank")


def hybrid_topk(spark, folder):
    """Nearest vectors fused with those of the same label that they lead to in one hop."""
    near = G.cosine_top_k(table(spark, folder, "embeddings"), "vec_id", "embedding", _queries(spark, folder), 20)
    ring = table(spark, folder, "embeddings").select(F.col("vec_id").alias("source"), (F.col("vec_id") + 1).alias("target"))
    from pyspark.sql import Window

    hops = G.one_hop(ring, near.where("rank <= 5").select("query_id", "vec_id"))
    hops = hops.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("hops"), "vec_id")))
    return G.fused([near, hops])


def page_sites(spark, folder):
    rows = A.page_sites(A.text_links(wrapped(spark, folder), "page_id", "raw"))
    return rows.groupBy("doc").agg(F.countDistinct("page_id").alias("pages"), F.countDistinct("site").alias("sites"))


def fetch_totals(spark, folder):
    rows = table(spark, folder, "fetch_attempts").distinct().select(F.col("tree_id").alias("doc"), F.col("page_id").alias("url"), F.coalesce(F.length("markdown") > 0, F.lit(False)).alias("ok"))
    return A.fetch_totals(rows)


def attachment_names_by_hash(spark, folder):
    rows = table(spark, folder, "conversion_results").select("source_file").distinct()
    return rows.select("source_file", T.collision_name(F.col("source_file"), F.substring_index("source_file", "/", -1)).alias("name"))


QUERIES = {
    f.__name__: f
    for f in (
        route_files, round_robin, path_collisions, status_summary, status_total, failure_log, stream_chunks, window_counts, plain_items, ingestible, text_chunks, questions, vector_topk, hybrid_topk, page_sites, fetch_totals, attachment_names_by_hash
    )
}

_FILES = "(SELECT DISTINCT source_file FROM conversion_results)"
_EXT = r"lower(regexp_extract(source_file, '[^/]\.([^./]+)\z', 1))"
_SKIP = "('avi','mp4','mov','mkv','webm','wmv','flv','m4v','mp3','wav','m4a','aac','flac','ogg','opus','wma','aiff','au')"
_ROUTED = f"""(SELECT source_file, ext, CASE WHEN ext IN {_SKIP} THEN 'skip_media' WHEN ext = 'xmind' THEN 'skip_xmind' WHEN ext IN ('doc','xls','ppt') THEN 'legacy' WHEN ext IN ('docx','pptx','xlsx','pdf','png','md','txt','jpg','jpeg') THEN 'direct' ELSE 'unsupported' END AS route
  FROM (SELECT source_file, {_EXT} AS ext FROM {_FILES}))"""
_RESULTS = "(SELECT DISTINCT * FROM conversion_results)"
_COUNTS = "count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed, bool_or(status = 'failed') AS failed_run"
_W = f"(SELECT page_id, {Q.WRAPPED} AS raw FROM {Q.PAGES})"

ORACLES = {
    "route_files": f"""SELECT source_file, ext, route, CASE WHEN route = 'legacy' THEN ext || 'x' WHEN route = 'direct' THEN ext END AS file_type,
      CASE route WHEN 'skip_media' THEN 'skip_audio_video' WHEN 'skip_xmind' THEN 'skip_xmind' WHEN 'legacy' THEN 'legacy_convert:.' || ext || '->' || ext || 'x' WHEN 'direct' THEN 'direct' ELSE '' END AS trace FROM {_ROUTED}""",
    "round_robin": f"SELECT source_file, ['vision-s', 'vision-m', 'layout-x'][(row_number() OVER (ORDER BY source_file) - 1) % 3 + 1] AS model FROM {_ROUTED} WHERE route NOT LIKE 'skip%' UNION ALL SELECT source_file, NULL FROM {_ROUTED} WHERE route LIKE 'skip%'",
    "path_collisions": rf"SELECT concat(regexp_replace(source_file, '([^/])\.[^./]+\z', '\1'), '.md') AS output_file, count(*) AS n_sources FROM {_FILES} GROUP BY 1 HAVING count(*) > 1",
    "status_summary": f"SELECT string_split(source_file, '/')[1] AS tree, {_COUNTS} FROM {_RESULTS} GROUP BY 1",
    "status_total": f"SELECT {_COUNTS} FROM {_RESULTS}",
    "failure_log": f"SELECT source_file, used_llm_model, status, error, preprocess_trace, round(elapsed_sec, 3) AS elapsed_sec, logged_at AS timestamp FROM {_RESULTS} WHERE status = 'failed'",
    "stream_chunks": f"SELECT stream_id, string_agg(coalesce(content, ''), '' ORDER BY seq) AS content, string_agg(coalesce(reasoning, ''), '' ORDER BY seq) AS reasoning FROM ({CHUNKS.replace('{events}', 'events')}) GROUP BY stream_id",
    "window_counts": "SELECT date_trunc('hour', ts) AS window_start, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2",
    "plain_items": "SELECT doc_id AS doc, 'text' AS type, md5(coalesce(text, '')) AS text_md5, CAST(0 AS INTEGER) AS page_idx FROM documents WHERE lower(file_type) IN ('md', 'txt')",
    "ingestible": "SELECT doc_id, file_type FROM documents WHERE lower(file_type) IN ('md', 'pdf', 'docx', 'xlsx', 'txt')",
    "text_chunks": "SELECT doc_id AS doc, CAST(k AS INTEGER) AS chunk_no, md5(substr(text, CAST(k AS BIGINT) * 1100 + 1, 1200)) AS chunk_md5 FROM (SELECT doc_id, text, unnest(range(0, CAST(floor(greatest(length(text) - 101, 0) / 1100) AS BIGINT) + 1)) AS k FROM documents WHERE length(text) > 0)",
    "questions": f"SELECT doc_id, q AS question FROM (SELECT doc_id, {Q.strip(chr(39) * 2 + ' || coalesce(CASE WHEN doc_id = 700 THEN ' + chr(39) + ' QUIT ' + chr(39) + ' ELSE title END, ' + chr(39) * 2 + ')')} AS q FROM documents) WHERE q <> '' AND doc_id < coalesce((SELECT min(doc_id) FROM documents WHERE doc_id = 700 OR lower({Q.strip('title')}) IN ('exit', 'quit')), 1e18)",
    "vector_topk": """SELECT query_id, vec_id, round(score, 4) AS score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS score
      FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)) WHERE r <= 10""",
    "page_sites": rf"""WITH p AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(raw, '(?i)[?&]pageId=([0-9]+)', 1))) AS i FROM {_W}), b AS (SELECT page_id, rtrim(unnest(list_concat(regexp_extract_all(raw, '(?i)(https?://[^{Q.WSC}"''`()<>\]]+)/pages/', 1), regexp_extract_all(raw, '(?i)(https?://[^{Q.WSC}"''`()<>\]]+)/download/attachments/', 1))), '/') AS s FROM {_W})
      SELECT page_id AS doc, count(DISTINCT i) AS pages, count(DISTINCT s) AS sites FROM p JOIN b USING (page_id) GROUP BY page_id""",
    "fetch_totals": "SELECT tree_id AS doc, count(*) FILTER (length(markdown) > 0) AS success, count(*) FILTER (NOT coalesce(length(markdown) > 0, false)) AS failed FROM (SELECT DISTINCT * FROM fetch_attempts) GROUP BY tree_id",
    "attachment_names_by_hash": f"SELECT source_file, concat(substr(md5(source_file), 1, 8), '_', string_split(source_file, '/')[-1]) AS name FROM {_FILES}",
}
