"""Run state: fetch fallback, failure rows, checkpoints and their load rules, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators.ranking import ranked

VERSION, ERROR_CHARS, LISTED_CHARS = 1, 2000, 500


def fetch_fallback(attempts: DataFrame) -> DataFrame:
    """(page_id, tree_id, title, markdown, error, strategy_idx): the first strategy with Markdown that isn't blank, else the last error and no Markdown.

    The error of a success is empty; a page whose attempts have no error text fails with the empty one.
    """
    good = F.coalesce(F.col("markdown").rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))
    win = F.struct("strategy_idx", "title", "markdown")
    lose = F.struct("strategy_idx", F.coalesce("error", F.lit("")).alias("error"))
    rows = attempts.where(F.col("page_id").isNotNull()).groupBy("page_id", "tree_id").agg(F.min(F.when(good, win)).alias("w"), F.max(lose).alias("l"))
    ok = F.col("w").isNotNull()
    return rows.select("page_id", "tree_id", F.coalesce(F.col("w.title"), F.concat(F.lit("page_"), "page_id")).alias("title"), F.col("w.markdown").alias("markdown"), F.when(ok, "").otherwise(F.col("l.error")).alias("error"), F.coalesce("w.strategy_idx", "l.strategy_idx").alias("strategy_idx"))


def failure_rows(failed: DataFrame, parts: Column) -> DataFrame:
    """Failure rows: error cut to 2,000 characters, path parts joined as they were before the failure suffix."""
    return failed.select("page_id", F.coalesce("title", F.lit("")).alias("title"), F.array_join(parts, "/").alias("relative_path"), F.substring(F.coalesce("error", F.lit("")), 1, ERROR_CHARS).alias("error"))


def failure_listing(failures: DataFrame) -> DataFrame:
    """(line_no, line): one entry a failure, errors cut to 500 characters; no rows if nothing failed. Repeated rows are one entry."""
    columns = ["page_id", "title", "relative_path", "error", "source_tree_json", "markdown_export_root"]
    text = {c: F.coalesce(F.col(c) if c in failures.columns else F.lit(None).cast("string"), F.lit("")).alias(c) for c in columns}
    rows = ranked(failures.select(*text.values()).distinct(), [F.col(c) for c in columns], out="line_no")
    extra = F.when((F.col("source_tree_json") != "") | (F.col("markdown_export_root") != ""), F.concat(F.lit("\n   树 JSON: "), "source_tree_json", F.lit("\n   导出根: "), "markdown_export_root")).otherwise("")
    line = F.concat(F.col("line_no").cast("string"), F.lit(". page_id="), "page_id", F.lit(" | "), "title", F.lit("\n   路径: "), "relative_path", extra, F.lit("\n   原因: "), F.substring("error", 1, LISTED_CHARS))
    return rows.select("line_no", line.alias("line"))


def load_state(states: DataFrame, tree_order: Column) -> DataFrame:
    """Per run the usable state of its latest checkpoint. ``states``: run_id, version, tree_order, trees_completed, last_page, status, reason, saved_at.

    A null version is an unreadable file: everything is reset. Another version, or another tree order, ignores the completed trees but keeps the last page.
    """
    latest = states.groupBy("run_id").agg(F.max_by(F.struct("version", "tree_order", "trees_completed", "last_page", "status"), "saved_at").alias("s"))
    readable = F.col("s.version").isNotNull()
    usable = readable & (F.col("s.version") == VERSION) & F.col("s.tree_order").eqNullSafe(tree_order)
    none = F.array().cast("array<string>")
    return latest.select(
        "run_id", F.when(usable, F.coalesce("s.trees_completed", none)).otherwise(none).alias("trees_completed"), F.when(readable, F.col("s.last_page")).alias("last_page"),
        F.when(readable, F.coalesce("s.status", F.lit(""))).otherwise("").alias("loaded_status"), F.lit("running").alias("status"), F.when(readable, "resume_start").otherwise("reset_corrupt").alias("reason"),
    )


STATE = "run_id string, version int, tree_order array<string>, trees_completed array<string>, last_page struct<tree_id: string, page_id: string, markdown_path: string>, status string, reason string, saved_at timestamp"


def save_state(spark: SparkSession, path: str, run_id: str, tree_order: list[str], completed: list[str], last_page: tuple[str, str, str] | None, status: str, reason: str) -> None:
    """Appends a checkpoint of a run: ``running`` with reasons init, page_saved and tree_done, at its end ``completed`` or ``interrupted``. One row; :func:`load_state` takes the latest."""
    row = spark.createDataFrame([(run_id, VERSION, tree_order, completed, last_page, status, reason, None)], STATE)
    row.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)


def last_saved(pages: DataFrame) -> DataFrame:
    """(tree_id, page_id, markdown_path): the last page saved in each tree, by pre-order. ``pages``: tree_id, page_id, preorder, markdown_path, status."""
    last = pages.where(F.col("status") == "ok").groupBy("tree_id").agg(F.max_by(F.struct("page_id", "markdown_path"), "preorder").alias("l"))
    return last.select("tree_id", "l.page_id", "l.markdown_path")


def run_outcome(statuses: DataFrame) -> DataFrame:
    """(tree_id, ok, fail, skipped, completed, status, exit_code): a run without an exception ends as completed even if pages failed, with code 1 then."""
    out = statuses.groupBy("tree_id").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "fail", "skipped")])
    return out.select("*", (F.col("fail") == 0).alias("completed"), F.lit("completed").alias("status"), F.when(F.col("fail") > 0, 1).otherwise(0).alias("exit_code"))


def interrupt_line(at: Column, exc: Column, trees_done: Column, ok: Column, fail: Column, skipped: Column, last_page_id: Column, checkpoint: Column) -> Column:
    """The line an interrupted run appends to its log."""
    return F.format_string("[%s] status=interrupted exc=%s | trees_done=%d ok=%d fail=%d skipped=%d | last_page_id=%s | checkpoint=%s", at, exc, trees_done, ok, fail, skipped, last_page_id, checkpoint)
