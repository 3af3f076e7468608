"""Queries of the tree operators and run state over the wiki tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import runs as R
from leafmill.operators import trees as X
from leafmill.plans import sqlkit as Q
from leafmill.session import table
from leafmill.sources.tree_json import nodes_of, tree_documents

#: A node that the sample queries use as a resume target or subtree root: the least id of a tree at depth 1.
SEGMENT = lambda: T.folder_segment(F.col("slug"), F.col("title"), F.col("id"))
#: Both engines: the old snapshot lacks a seventh of the pages, has stale titles, and pages that are gone.
SNAPSHOT = """SELECT tree_id, parent_id, id, pos, CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN concat('old ', coalesce(title, '')) ELSE title END AS title, node_type, slug FROM {nodes} WHERE parent_id IS NULL OR CAST(id AS BIGINT) % 7 <> 0
  UNION ALL SELECT tree_id, parent_id, concat('9', id) AS id, pos + 1000 AS pos, 'gone' AS title, node_type, slug FROM {nodes} WHERE parent_id IS NOT NULL AND CAST(id AS BIGINT) % 11 = 0"""


def _expanded(spark: SparkSession, folder: str, max_depth: int | None = None) -> DataFrame:
    roots = table(spark, folder, "page_trees").select("tree_id", "root_id")
    return X.expand(table(spark, folder, "page_nodes"), roots, max_depth)


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    nodes = X.distinct_nodes(table(spark, folder, "page_nodes"))
    return spark.sql(SNAPSHOT.replace("{nodes}", "{n}"), n=nodes)


def _fetched(spark: SparkSession, folder: str) -> DataFrame:
    return R.fetch_fallback(table(spark, folder, "fetch_attempts"))


def _statuses(spark: SparkSession, folder: str) -> DataFrame:
    return _fetched(spark, folder).select("tree_id", F.col("page_id").alias("id"), F.when(F.col("markdown").isNotNull(), "ok").otherwise("fail").alias("status"))


def tree_expand(spark, folder):
    return _expanded(spark, folder).select("tree_id", "id", "parent_id", "depth", F.array_join("ids", "/").alias("id_path"))


def tree_depth_limit(spark, folder):
    return _expanded(spark, folder, 2).select("tree_id", "id", "depth")


def tree_preorder(spark, folder):
    return X.preorder(_expanded(spark, folder)).select("tree_id", "id", "preorder")


def tree_contains(spark, folder):
    return X.contains_id(_expanded(spark, folder), "990000001")


def tree_subtree(spark, folder):
    rows = _expanded(spark, folder)
    top = rows.where("depth = 1").agg(F.min("id")).first()[0] or ""
    return X.subtree(rows, top).select("tree_id", "id", "depth")


def tree_reconcile(spark, folder):
    out = X.reconcile(table(spark, folder, "page_nodes"), _snapshot(spark, folder))
    return out.select("tree_id", "parent_id", "id", "pos", "title", "state")


def tree_fetch_plan(spark, folder):
    return X.fetch_plan(table(spark, folder, "page_nodes"), _snapshot(spark, folder))


def _named(spark, folder):
    return X.unique_names(_expanded(spark, folder), SEGMENT())


def sibling_names(spark, folder):
    return _named(spark, folder).select("tree_id", "id", "folder")


def tree_paths(spark, folder):
    return X.paths(_named(spark, folder)).select("tree_id", "id", "rel_path")


def failed_paths(spark, folder):
    failed = _statuses(spark, folder).where("status = 'fail'").select("tree_id", "id")
    return X.paths(_named(spark, folder), failed).select("tree_id", "id", "rel_path")


def tree_drawing(spark, folder):
    return X.drawing(_expanded(spark, folder)).select("tree_id", "id", "line")


def tree_counts(spark, folder):
    return X.node_counts(_expanded(spark, folder))


def tree_json(spark, folder):
    return tree_documents(_expanded(spark, folder))


def tree_json_nodes(spark, folder):
    return nodes_of(tree_documents(_expanded(spark, folder)), "tree_id", "json")


def export_roots(spark, folder):
    return X.export_roots(table(spark, folder, "page_trees").select("tree_id").distinct(), "output/wiki")


def resume_plan(spark, folder):
    ordered = X.preorder(_expanded(spark, folder))
    targets = ordered.where("depth = 1").groupBy("tree_id").agg(F.min("id").alias("target_id")).where("tree_id < 'tree_20'")
    existing = _fetched(spark, folder).select("tree_id", F.col("page_id").alias("id"), F.coalesce(F.length("markdown"), F.lit(0)).alias("size"))
    return X.resume_plan(ordered, targets, existing).select("tree_id", "id", "action")


def completed_trees(spark, folder):
    return X.completed_trees(_statuses(spark, folder))


def fetch_fallback(spark, folder):
    return _fetched(spark, folder).select("page_id", "tree_id", "title", F.md5(F.col("markdown").cast("binary")).alias("markdown_md5"), "error", "strategy_idx")


def failure_rows(spark, folder):
    failed = _fetched(spark, folder).where("markdown IS NULL").withColumnRenamed("page_id", "id").drop("title")
    rows = X.paths(_named(spark, folder)).join(failed.select("tree_id", "id", "error"), ["tree_id", "id"])
    return R.failure_rows(rows.withColumnRenamed("id", "page_id"), F.col("rel_parts"))


def failure_listing(spark, folder):
    return R.failure_listing(table(spark, folder, "export_failures"))


def run_outcome(spark, folder):
    return R.run_outcome(_statuses(spark, folder))


def last_saved(spark, folder):
    ordered = X.preorder(_expanded(spark, folder)).select("tree_id", "id", "preorder")
    rows = ordered.join(_statuses(spark, folder), ["tree_id", "id"])
    return R.last_saved(rows.select("tree_id", F.col("id").alias("page_id"), "preorder", F.concat("tree_id", F.lit("/"), "id", F.lit(".md")).alias("markdown_path"), "status"))


#: Both engines: checkpoints of runs, one run per tree, several states a run.
STATES = """SELECT tree_id AS run_id, CASE WHEN k = 0 AND tree_id LIKE '%_1%' THEN NULL WHEN k = 1 THEN 2 ELSE 1 END AS version, CASE WHEN tree_id LIKE '%_2%' THEN array({a}, 'x') ELSE array({a}, {b}) END AS tree_order,
  array({a}) AS trees_completed, concat('page', k) AS last_page, CASE WHEN k % 2 = 0 THEN 'interrupted' ELSE 'completed' END AS status, 'page_saved' AS reason, concat('2025-01-0', CAST((k * 5 + length(root_id) + length(title)) % 9 + 1 AS STRING), CAST(k AS STRING)) AS saved_at
  FROM (SELECT DISTINCT tree_id, root_id, title FROM {trees}) CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2)"""


def run_state(spark, folder):
    states = spark.sql(STATES.format(a="'t1'", b="'t2'", trees="{t}"), t=table(spark, folder, "page_trees"))  # three states a site: a fixture of fixed size
    out = R.load_state(states, F.array(F.lit("t1"), F.lit("t2")))
    return out.select("run_id", F.array_join("trees_completed", ",").alias("trees_completed"), "last_page", "loaded_status", "status", "reason")


QUERIES = {
    f.__name__: f
    for f in (
        tree_expand, tree_depth_limit, tree_preorder, tree_contains, tree_subtree, tree_reconcile, tree_fetch_plan, sibling_names, tree_paths, failed_paths, tree_drawing, tree_counts, tree_json, tree_json_nodes, export_roots, resume_plan, completed_trees,
        fetch_fallback, failure_rows, failure_listing, run_outcome, last_saved, run_state,
    )
}

_TREE = f"""WITH RECURSIVE n AS MATERIALIZED (SELECT * FROM {Q.NODES}), t AS (
  SELECT n.tree_id, n.id, n.parent_id, n.pos, n.title, n.slug, 0 AS depth, [n.id] AS ids, [{{'pos': n.pos, 'id': n.id}}] AS ord FROM n JOIN (SELECT DISTINCT tree_id, root_id FROM page_trees) r ON n.tree_id = r.tree_id AND n.id = r.root_id
  UNION ALL SELECT c.tree_id, c.id, c.parent_id, c.pos, c.title, c.slug, t.depth + 1, list_append(t.ids, c.id), list_append(t.ord, {{'pos': c.pos, 'id': c.id}}) FROM t JOIN n c ON c.tree_id = t.tree_id AND c.parent_id = t.id WHERE NOT list_contains(t.ids, c.id))"""
_SEG = f"CASE WHEN {Q.strip(chr(39) * 2 + ' || coalesce(slug, ' + chr(39) * 2 + ')')} <> '' THEN {Q.file_name('slug')} ELSE {Q.file_name('coalesce(nullif(title, ' + chr(39) * 2 + '), ' + chr(39) + 'page_' + chr(39) + ' || id)')} END"
#: The ordered fold over siblings, one after the other.
_NAMED = (
    _TREE
    + f""", s AS (SELECT tree_id, coalesce(parent_id, '') AS par, id, {_SEG} AS seg, row_number() OVER (PARTITION BY tree_id, coalesce(parent_id, '') ORDER BY pos, id) AS k FROM t), f AS (
  SELECT tree_id, par, id, k, seg AS folder, [seg] AS used FROM s WHERE k = 1
  UNION ALL SELECT s.tree_id, s.par, s.id, s.k, CASE WHEN list_contains(f.used, s.seg) THEN s.seg || '_' || s.id ELSE s.seg END, list_append(f.used, CASE WHEN list_contains(f.used, s.seg) THEN s.seg || '_' || s.id ELSE s.seg END)
  FROM f JOIN s ON s.tree_id = f.tree_id AND s.par = f.par AND s.k = f.k + 1)"""
)
_FALLBACK = Q.FALLBACK
_PATHS = ", p AS (SELECT tree_id, id, folder AS path FROM f JOIN t USING (tree_id, id) WHERE depth = 0 UNION ALL SELECT c.tree_id, c.id, p.path || '/' || c.folder FROM p JOIN (SELECT f.*, t.parent_id FROM f JOIN t USING (tree_id, id)) c ON c.tree_id = p.tree_id AND c.parent_id = p.id)"
_FAILED_PATHS = (
    _PATHS.replace("SELECT tree_id, id, folder AS path FROM f JOIN t USING (tree_id, id) WHERE depth = 0", "SELECT tree_id, id, nm AS path FROM g WHERE depth = 0")
    .replace("p.path || '/' || c.folder", "p.path || '/' || c.nm").replace("(SELECT f.*, t.parent_id FROM f JOIN t USING (tree_id, id)) c", "g c")
)
_SNAP = "(" + SNAPSHOT.replace("{nodes}", Q.NODES) + ")"
_STATUS = f"(SELECT tree_id, page_id AS id, CASE WHEN markdown IS NULL THEN 'fail' ELSE 'ok' END AS status FROM {_FALLBACK})"

ORACLES = {
    "tree_expand": _TREE + " SELECT tree_id, id, parent_id, CAST(depth AS INTEGER) AS depth, array_to_string(ids, '/') AS id_path FROM t",
    "tree_depth_limit": _TREE + " SELECT tree_id, id, CAST(depth AS INTEGER) AS depth FROM t WHERE depth <= 2",
    "tree_preorder": _TREE + " SELECT tree_id, id, row_number() OVER (PARTITION BY tree_id ORDER BY ord) AS preorder FROM t",
    "tree_contains": _TREE + " SELECT tree_id, bool_or(id = '990000001') AS contains FROM t GROUP BY tree_id",
    "tree_subtree": _TREE + ", top AS (SELECT min(id) AS i FROM t WHERE depth = 1) SELECT tree_id, id, CAST(depth - list_position(ids, i) + 1 AS INTEGER) AS depth FROM t, top WHERE list_contains(ids, i)",
    "tree_reconcile": f"""WITH a AS (SELECT * FROM {Q.NODES} WHERE parent_id IS NOT NULL), s AS (SELECT tree_id, parent_id, id, arg_max(coalesce(title, '\x01'), pos) AS title FROM {_SNAP} WHERE parent_id IS NOT NULL AND id IS NOT NULL GROUP BY ALL)
      SELECT tree_id, parent_id, id, a.pos, CASE WHEN s.title IS NULL THEN a.title WHEN s.title = '\x01' THEN NULL ELSE s.title END AS title, CASE WHEN a.pos IS NULL THEN 'dropped' WHEN s.title IS NULL THEN 'new' ELSE 'kept' END AS state FROM a FULL JOIN s USING (tree_id, parent_id, id)""",
    "tree_fetch_plan": f"""WITH a AS MATERIALIZED (SELECT * FROM {Q.NODES}), s AS MATERIALIZED (SELECT * FROM {_SNAP}), ac AS (SELECT tree_id, parent_id, list_sort(list_distinct(list(id))) AS l, count(*) AS n FROM a WHERE parent_id IS NOT NULL GROUP BY ALL),
      sc AS (SELECT tree_id, parent_id, list_sort(list_distinct(list(id))) AS l, count(*) AS n FROM s WHERE parent_id IS NOT NULL AND id <> '' GROUP BY ALL), old AS (SELECT tree_id, id, arg_max(title, pos) AS title FROM s GROUP BY ALL)
      SELECT tree_id, parent_id, n_children, fast, CASE WHEN fast THEN old_title ELSE coalesce(nullif(meta_title, ''), 'page_' || parent_id) END AS title FROM (SELECT ac.tree_id, ac.parent_id, ac.n AS n_children, coalesce(ac.l = sc.l AND ac.n = sc.n, false) AND old.id IS NOT NULL AND m.parent_id IS NOT NULL AS fast, m.title AS meta_title, old.title AS old_title
      FROM ac JOIN a m ON m.tree_id = ac.tree_id AND m.id = ac.parent_id LEFT JOIN sc ON sc.tree_id = ac.tree_id AND sc.parent_id = ac.parent_id LEFT JOIN old ON old.tree_id = ac.tree_id AND old.id = ac.parent_id)""",
    "sibling_names": _NAMED + " SELECT tree_id, id, folder FROM f",
    "tree_paths": _NAMED + _PATHS + " SELECT tree_id, id, path AS rel_path FROM p",
    "failed_paths": _NAMED + f", g AS (SELECT f.tree_id, f.id, t.parent_id, t.depth, folder || CASE WHEN status = 'fail' THEN '_空' ELSE '' END AS nm FROM f JOIN t USING (tree_id, id) LEFT JOIN {_STATUS} USING (tree_id, id))" + _FAILED_PATHS + " SELECT tree_id, id, path AS rel_path FROM p",
    "tree_drawing": _TREE
    + """, e AS (SELECT tree_id, id, depth, parent_id, title, ids, depth = 0 OR row_number() OVER (PARTITION BY tree_id, parent_id ORDER BY pos DESC, id DESC) = 1 AS fin FROM t),
      st AS (SELECT tree_id, id, unnest(ids) AS step, generate_subscripts(ids, 1) AS k FROM t)
      SELECT e.tree_id, e.id, concat(coalesce(string_agg(CASE WHEN a.fin THEN '    ' ELSE '│   ' END, '' ORDER BY st.k) FILTER (a.id <> e.id), ''), CASE WHEN e.fin THEN '└── ' ELSE '├── ' END, coalesce(e.title, ''), '  (id=', e.id, ')') AS line
      FROM e JOIN st ON st.tree_id = e.tree_id AND st.id = e.id JOIN e a ON a.tree_id = st.tree_id AND a.id = st.step GROUP BY e.tree_id, e.id, e.fin, e.title""",
    "tree_counts": _TREE + " SELECT tree_id, count(*) AS visited, CAST(max(depth) AS INTEGER) AS max_depth, count(*) FILTER (NOT EXISTS (SELECT 1 FROM t c WHERE c.tree_id = t.tree_id AND c.parent_id = t.id)) AS leaves FROM t GROUP BY tree_id",
    "tree_json_nodes": _TREE + " SELECT tree_id, id, parent_id, CAST(row_number() OVER (PARTITION BY tree_id, parent_id ORDER BY pos, id) - 1 AS INTEGER) AS pos, coalesce(nullif(title, ''), 'page_' || id) AS title, (SELECT any_value(node_type) FROM n WHERE n.tree_id = t.tree_id AND n.id = t.id) AS node_type, slug FROM t",
    "export_roots": "SELECT tree_id, 'output/wiki/' || tree_id AS out_root FROM (SELECT DISTINCT tree_id FROM page_trees)",
    "resume_plan": _TREE
    + f""", o AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY ord) AS r FROM t), g AS (SELECT tree_id, min(id) AS target FROM t WHERE depth = 1 AND tree_id < 'tree_20' GROUP BY tree_id), u AS (SELECT o.tree_id, o.r AS upto FROM o JOIN g ON o.tree_id = g.tree_id AND o.id = g.target)
      SELECT tree_id, o.id, CASE WHEN r <= upto THEN 'skip_before' WHEN length(b.markdown) > 0 THEN 'skip_existing' ELSE 'export' END AS action FROM o LEFT JOIN u USING (tree_id) LEFT JOIN (SELECT tree_id, page_id AS id, markdown FROM {_FALLBACK}) b USING (tree_id, id)""",
    "completed_trees": f"SELECT tree_id FROM {_STATUS} GROUP BY tree_id HAVING count(*) FILTER (status = 'fail') = 0",
    "fetch_fallback": f"SELECT page_id, tree_id, title, md5(markdown) AS markdown_md5, error, strategy_idx FROM {_FALLBACK}",
    "failure_rows": _NAMED + _PATHS + f" SELECT p.id AS page_id, coalesce(t.title, '') AS title, path AS relative_path, substr(b.error, 1, 2000) AS error FROM p JOIN t USING (tree_id, id) JOIN (SELECT tree_id, page_id AS id, error FROM {_FALLBACK} WHERE markdown IS NULL) b USING (tree_id, id)",
    "failure_listing": """SELECT line_no, concat(line_no, '. page_id=', page_id, ' | ', title, chr(10), '   路径: ', relative_path, CASE WHEN s <> '' OR r <> '' THEN concat(chr(10), '   树 JSON: ', s, chr(10), '   导出根: ', r) ELSE '' END, chr(10), '   原因: ', substr(error, 1, 500)) AS line
      FROM (SELECT *, row_number() OVER (ORDER BY page_id, title, relative_path, error, s, r) AS line_no FROM (SELECT DISTINCT page_id, coalesce(title, '') AS title, coalesce(relative_path, '') AS relative_path, coalesce(error, '') AS error, coalesce(source_tree_json, '') AS s, coalesce(markdown_export_root, '') AS r FROM export_failures))""",
    "run_outcome": f"SELECT tree_id, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'fail') AS fail, CAST(0 AS BIGINT) AS skipped, count(*) FILTER (status = 'fail') = 0 AS completed, 'completed' AS status, CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 1 ELSE 0 END AS exit_code FROM {_STATUS} GROUP BY tree_id",
    "last_saved": _TREE + f" SELECT tree_id, arg_max(id, ord) AS page_id, tree_id || '/' || arg_max(id, ord) || '.md' AS markdown_path FROM t JOIN {_STATUS} USING (tree_id, id) WHERE status = 'ok' GROUP BY tree_id",
    "run_state": "WITH s AS ("
    + STATES.format(a="'t1'", b="'t2'", trees="page_trees").replace("array(", "list_value(")
    + """), l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY saved_at DESC) = 1) SELECT run_id, CASE WHEN version = 1 AND tree_order = ['t1', 't2'] THEN array_to_string(trees_completed, ',') ELSE '' END AS trees_completed,
      CASE WHEN version IS NULL THEN NULL ELSE last_page END AS last_page, CASE WHEN version IS NULL THEN '' ELSE status END AS loaded_status, 'running' AS status, CASE WHEN version IS NULL THEN 'reset_corrupt' ELSE 'resume_start' END AS reason FROM l""",
}
