"""The pipeline's entries as functions with keyword options. Each returns its exit code; tables, backends and converters are passed in, so nothing here opens a network.

Codes: 0 done, 1 some items failed, 2 bad arguments or no input, 3 nothing to do or a missing credential, 4 ended by an error, 130 interrupted.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import attachments, cleaning, conversion, retrieval, runs, trees
from leafmill.operators.ranking import bounded_broadcast
from leafmill.session import cut
from leafmill.sources import connectors, files, sinks
from leafmill.sources.tree_json import tree_documents

LOG = logging.getLogger("leafmill")
#: Larger files can't be read as one value.
MOST_BYTES = (1 << 31) - 1


def crawl(nodes: DataFrame, output: str, *, root_page_id: str | None = None, resume_from_page_id: str | None = None, checkpoint_root_id: str | None = None, snapshot: DataFrame | None = None, max_depth: int | None = None, skip_complete_snapshot: bool = True) -> int:
    """Expands the tree under a root and writes its document; with a snapshot also what was kept, new and dropped and which parents needed a fetch."""
    try:
        root = trees.choose_root(checkpoint_root_id, resume_from_page_id, root_page_id)
    except ValueError:
        return 2
    tops = nodes.where(F.col("id") == root).select("tree_id", F.col("id").alias("root_id")).distinct()
    found = cut(trees.expand(nodes, tops, max_depth))
    if found.isEmpty():
        LOG.warning("no page %s", root)
        return 3
    if snapshot is not None and max_depth is not None:
        found = cut(trees.expand(trees.with_snapshot_below(found, snapshot, max_depth), tops))
    tree_documents(found).write.mode("overwrite").parquet(f"{output}/trees")
    if snapshot is not None:
        trees.reconcile(nodes, snapshot).write.mode("overwrite").parquet(f"{output}/reconciled")
        trees.fetch_plan(nodes, snapshot, skip_complete_snapshot).write.mode("overwrite").parquet(f"{output}/fetches")
    return 0


def crawl_site(spark: SparkSession, make_backend: Callable[[], connectors.Backend], output: str, *, tree_id: str, root_page_id: str | None = None, resume_from_page_id: str | None = None, checkpoint_root_id: str | None = None, snapshot: DataFrame | None = None,
               max_depth: int | None = None, limit: int = 50, pause: tuple[float, float] = (1.0, 3.0), sleep: Callable[[float], None] = time.sleep, checkpoint_every: int = 20) -> int:
    """Lists a site level by level through a backend, made on each worker and paused before each call, then expands and writes as :func:`crawl` does.

    A snapshot of what is known is written after each level in which ``checkpoint_every`` pages have been passed, and when the crawl ends early.
    """
    try:
        root = trees.choose_root(checkpoint_root_id, resume_from_page_id, root_page_id)
    except ValueError as e:
        LOG.error("%s", e)
        return 2
    low, high = pause
    backend = lambda: connectors.throttled(make_backend(), low, high, sleep)
    nodes, written = None, 0
    try:
        try:
            top = connectors.page_meta(backend(), root)
        except connectors.RestError as e:
            LOG.error("root page %s: %s", root, e)
            return 3
        nodes = cut(spark.createDataFrame([(tree_id, root, None, 0, top["title"], top["type"], top["slug"])], "tree_id string, id string, parent_id string, pos int, title string, node_type string, slug string"))
        level, depth, done = nodes, 0, 1
        while max_depth is None or depth < max_depth:
            listed = connectors.children_of(level, backend, limit=limit).select(*nodes.columns)
            level = cut(listed.dropDuplicates(["tree_id", "id"]).join(nodes.select("tree_id", "id"), ["tree_id", "id"], "left_anti").select(*nodes.columns))
            found = level.count()
            if not found:
                break
            nodes, depth, done = cut(nodes.unionByName(level)), depth + 1, done + found
            if any(sinks.snapshot_due(n, checkpoint_every) for n in range(written + 1, done + 1)):
                _write_nodes(nodes, f"{output}/snapshot")
                written = done
    except KeyboardInterrupt:
        LOG.warning("interrupted")
        if nodes is not None:
            _write_nodes(nodes, f"{output}/snapshot")
        return 130
    except Exception as e:  # noqa: BLE001 - what is known is kept
        LOG.error("crawl ended: %s", e)
        if nodes is not None:
            _write_nodes(nodes, f"{output}/snapshot")
        return 4
    return crawl(nodes, output, root_page_id=root, snapshot=snapshot, max_depth=max_depth)


def _write_nodes(nodes: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(path)


def export(nodes: DataFrame, roots: DataFrame, attempts: DataFrame, output: str, *, resume: bool = False, existing: DataFrame | None = None, targets: DataFrame | None = None, site_name: str = "wiki", max_fetch_strategies: int = 2, run_id: str = "run", as_files: str | None = None) -> int:
    """Writes one Markdown row a page at its path (with ``as_files`` also a file each below that shared folder), the failures and the outcome by tree; pages and completed trees that a
    resumed run has are left out. The run's state is appended to ``state`` below the output: init, page_saved with the last page, tree_done, completed; interrupted on an early end."""
    spark = nodes.sparkSession
    strategies = max(1, min(2, max_fetch_strategies))
    order = [r[0] for r in roots.select("tree_id").distinct().orderBy("tree_id").collect()]  # one row a site
    state = f"{output}/state"
    completed: list[str] = []
    last: tuple[str, str, str] | None = None
    if resume:
        loaded = _loaded_state(spark, state, run_id, order)
        completed, last = (list(loaded["trees_completed"]), tuple(loaded["last_page"]) if loaded["last_page"] else None) if loaded else ([], None)
        if targets is None and loaded and loaded["interrupted"] and last:
            targets = spark.createDataFrame([(last[0], last[1])], "tree_id string, target_id string")
        roots = roots.where(~F.col("tree_id").isin(completed)) if completed else roots
    try:
        ordered = trees.preorder(trees.expand(nodes, roots))
        if ordered.isEmpty():
            return 0 if completed else 2
        runs.save_state(spark, state, run_id, order, completed, last, "running", "init")
        none = spark.createDataFrame([], "tree_id string, id string, size long")
        no_target = spark.createDataFrame([], "tree_id string, target_id string")
        planned = trees.resume_plan(ordered, targets if resume and targets is not None else no_target, existing if resume and existing is not None else none)
        got = runs.fetch_fallback(attempts.where(F.col("strategy_idx") < strategies)).select("tree_id", F.col("page_id").alias("id"), F.col("title").alias("fetched"), "markdown", "error")
        named = trees.unique_names(planned, T.folder_segment(F.col("slug"), F.col("title"), F.col("id")))
        plain = trees.paths(named).select("tree_id", "id", F.col("rel_parts").alias("plain_parts"))
        rows = named.join(got, ["tree_id", "id"], "left")
        status = F.when(F.col("action") != "export", "skipped").when(F.col("markdown").isNotNull(), "ok").otherwise("fail")
        rows = cut(rows.withColumn("status", status))
        placed = trees.paths(rows, rows.where("status = 'fail'").select("tree_id", "id")).join(plain, ["tree_id", "id"])
        stem = T.page_stem(F.col("title"), F.col("fetched"), F.col("slug"), F.col("id"), site_name)
        placed = cut(placed.withColumn("path", T.page_path(F.concat_ws("/", "tree_id", "rel_path"), stem)))
        pages = placed.where("status = 'ok'").select(F.col("path").alias("rel_path"), F.col("markdown").alias("content"))
        sinks.write_pages(pages, f"{output}/pages", "append" if resume else "overwrite")
        if as_files:
            sinks.write_page_files(pages, as_files)
        saved = runs.last_saved(placed.withColumnsRenamed({"id": "page_id", "path": "markdown_path"})).orderBy(F.desc("tree_id")).first()
        last = (saved["tree_id"], saved["page_id"], saved["markdown_path"]) if saved else last
        runs.save_state(spark, state, run_id, order, completed, last, "running", "page_saved")
        failed = placed.where("status = 'fail'").withColumnRenamed("id", "page_id")
        any_failed = sinks.write_failures(runs.failure_rows(failed, F.col("plain_parts")), f"{output}/failures")
        runs.run_outcome(placed).write.mode("overwrite").parquet(f"{output}/outcome")
        completed += [r[0] for r in trees.completed_trees(placed).orderBy("tree_id").collect()]
        runs.save_state(spark, state, run_id, order, completed, last, "running", "tree_done")
        runs.save_state(spark, state, run_id, order, completed, last, "completed", "finished")
        return int(any_failed)
    except (KeyboardInterrupt, Exception) as e:  # noqa: BLE001 - the state says where to go on
        LOG.error("export ended: %s", e)
        runs.save_state(spark, state, run_id, order, completed, last, "interrupted", type(e).__name__)
        line = runs.interrupt_line(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), F.lit(type(e).__name__), F.lit(len(completed)), F.lit(0), F.lit(0), F.lit(0), F.lit(last[1] if last else ""), F.lit(state))
        sinks.append_lines(spark.range(1).select(line.alias("line")), f"{output}/interrupt_log")
        return 130 if isinstance(e, KeyboardInterrupt) else 4


def _loaded_state(spark: SparkSession, path: str, run_id: str, order: list[str]):
    """The latest usable state of a run, or None."""
    if not files.path_kind(spark, path):
        return None
    states = spark.read.schema(runs.STATE).parquet(path).where(F.col("run_id") == run_id)
    found = runs.load_state(states, F.array(*[F.lit(t) for t in order])).first()
    if found is None:
        return None
    status = states.orderBy(F.desc("saved_at")).select("status").first()[0]
    return {**found.asDict(), "interrupted": status == "interrupted"}


def clean(spark: SparkSession, input_dir: str, output: str, *, listings: DataFrame | None = None, fetch: Callable[[str], bytes] | None = None, attachment_dir: str | None = None, default_site: str = "") -> int:
    """Cleans all Markdown files below a folder into a table (rel_path, content, author, last_modified), with the totals and the files that failed.

    A file that can't be read or cleaned fails alone; the code is 1 then. With ``fetch`` the attachments that raw or cleaned texts link (``listings``: site, page_id, att_id, title, download) are
    fetched into ``attachment_dir``; their counts by file are written too.
    """
    if not files.path_kind(spark, input_dir):
        return 2
    sizes = files.list_files(spark, input_dir, glob="*.md")
    large = sizes.where(F.col("size") > MOST_BYTES).select("rel_path", F.lit("too large").alias("error"))
    rows = files.markdown_files(spark, input_dir, MOST_BYTES)
    done = cut(cleaning.clean_pages(rows, "text", error="error").select("rel_path", "text", F.col("cleaned").alias("content"), "author", "last_modified", "error"))
    good = done.where("error IS NULL")
    good.select("rel_path", "content", "author", "last_modified").write.mode("overwrite").parquet(f"{output}/pages")
    cleaning.clean_totals(good, "text", "content").write.mode("overwrite").parquet(f"{output}/totals")
    failed = done.where("error IS NOT NULL").select("rel_path", "error").unionByName(large)
    any_failed = sinks.write_failures(failed, f"{output}/failures")
    if fetch is not None and attachment_dir:
        listed = listings if listings is not None else spark.createDataFrame([], "site string, page_id string, att_id string, title string, download string")
        plan = attachments.attachment_plan(good, "rel_path", "text", listed, "content", default_site)
        got = cut(sinks.fetch_attachments(plan, attachment_dir, fetch))
        attachments.fetch_totals(got).write.mode("overwrite").parquet(f"{output}/attachments")
        any_failed = any_failed or not got.where("NOT ok").isEmpty()
    return int(any_failed)


def convert(spark: SparkSession, input_dir: str, output: str, *, converter: Callable[[str, bytes], str], key: str | None, date: str, models: list[str] | None = None, upgrade: Callable[[str, bytes], tuple[str, bytes]] | None = None) -> int:
    """Converts all files below a folder through the injected converter (legacy ones through ``upgrade`` first); writes Markdown rows, results and appended failures.

    Files are routed where they are read; only names travel to assign models and to find colliding outputs. Of sources with one output path the first in order has it, later ones get their
    extension into the name and are flagged in the results.
    """
    try:
        retrieval.checked_key("converter key", key)
    except ValueError:
        return 3
    if not files.path_kind(spark, input_dir):
        return 2
    listed = conversion.routed(files.list_files(spark, input_dir).select("rel_path"), "rel_path")
    first = listed.where("route IN ('direct', 'legacy')").groupBy(T.markdown_path(F.col("rel_path")).alias("output_file")).agg(F.min("rel_path").alias("first"))
    planned = conversion.assigned(listed, "rel_path", models).select("rel_path", "model").withColumn("output_file", T.markdown_path(F.col("rel_path"))).join(first, "output_file", "left")
    planned = planned.withColumn("collides", F.coalesce(F.col("rel_path") != F.col("first"), F.lit(False))).drop("first")
    longer = F.concat(F.regexp_replace("rel_path", r"\.([^./]+)\z", "_$1"), F.lit(".md"))
    planned = cut(planned.withColumn("output_file", F.when(F.col("collides"), longer).otherwise(F.col("output_file"))))
    scanned = conversion.routed(files.list_files(spark, input_dir, content=True).where(F.col("size") <= MOST_BYTES).select("rel_path", "content"), "rel_path")
    results = cut(conversion.converted(scanned, "rel_path", "content", converter, upgrade).join(bounded_broadcast(planned), "rel_path"))
    pages = conversion.cleaned_conversion(results.where("status = 'ok'"), "text", "rel_path", "file_type", "model", date)
    sinks.write_pages(pages.select(F.col("output_file").alias("rel_path"), F.col("markdown").alias("content")), f"{output}/pages")
    results.drop("text").write.mode("overwrite").parquet(f"{output}/results")
    failed = results.where("status = 'failed'")
    sinks.append_failures(failed.select(F.col("rel_path").alias("source_file"), F.col("model").alias("used_llm_model"), "status", "error", F.col("trace").alias("preprocess_trace"), "elapsed_sec"), f"{output}/failure_log")
    return int(not failed.isEmpty())


def ingest(pages: DataFrame, output: str, *, embed: Callable[[list[str]], list[list[float]]] = retrieval.hashed_embedding) -> int:
    """Chunks and embeds pages (rel_path, content) of ingestible types into a chunk table."""
    rows = pages.withColumn("file_type", F.regexp_replace(T.extension(F.col("rel_path")), r"\A\.", ""))
    pieces = retrieval.chunks(retrieval.ingestible(rows, "file_type"), "rel_path", "content")
    pieces = pieces.withColumn("vec_id", F.xxhash64("doc", "chunk_no"))
    retrieval.embedded(pieces, "chunk", embed).write.mode("overwrite").parquet(f"{output}/chunks")
    return 0


def chat(lines: DataFrame, chunks: DataFrame, output: str, *, complete: Callable[[str, str], str], embed: Callable[[list[str]], list[list[float]]] = retrieval.hashed_embedding, k: int = 5) -> int:
    """Answers the questions (order, line) up to the first ``exit`` or ``quit`` from their nearest chunks."""
    asked = cut(retrieval.embedded(retrieval.questions(lines, "order", "line"), "question", embed, "vector"))
    if asked.isEmpty():
        return 3
    near = retrieval.cosine_top_k(chunks, "vec_id", "embedding", asked.select(F.col("order").alias("query_id"), "vector"), k)
    context = near.join(chunks.select("vec_id", "chunk"), "vec_id").groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "chunk"))), lambda s: s["chunk"]), "\n").alias("context"))
    rows = asked.join(context, asked["order"] == context["query_id"], "left").select("order", "question", "context")
    retrieval.answered(rows, "question", "context", complete).write.mode("overwrite").parquet(f"{output}/answers")
    return 0
