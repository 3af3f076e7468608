"""Incremental cleaning: Markdown files that arrive in a folder are cleaned once and added to a Parquet table.

The stream's own checkpoint keeps which files were read. Every batch writes its own folder, so a batch that is repeated after a failure replaces itself; a file that arrives again
with another time is cleaned again, and :func:`latest_cleaned` takes its newest version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.operators.cleaning import clean_pages
from leafmill.operators.ranking import bounded_broadcast
from leafmill.session import cut

COLUMNS = ["path", "mtime", "cleaned", "author", "last_modified"]


def arriving_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of (path, mtime, text) of a folder's Markdown files."""
    lines = spark.readStream.schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(folder)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("mtime"), F.col("value").alias("text"))


def add_cleaned(batch: DataFrame, table: str, batch_id: int | None = None) -> None:
    """Cleans a batch into its own folder of the table, which a repeated batch replaces: nothing is read back, and nothing is there twice.

    Rows without a batch number come from outside of a stream: those whose (path, mtime) the table has, or whose path if they have no mtime, are left out. Of the table only these two
    columns are read, and nothing of it is shuffled.
    """
    rows = batch if "mtime" in batch.columns else batch.withColumn("mtime", F.lit(None).cast("timestamp"))
    rows = rows.dropDuplicates(["path", "mtime"])
    if batch_id is None:
        try:
            there = batch.sparkSession.read.parquet(table).select(F.col("path").alias("p"), F.col("mtime").alias("m"))
            same = (F.col("path") == F.col("p")) & (F.col("mtime").isNull() | F.col("mtime").eqNullSafe(F.col("m")))
            known = cut(there.join(bounded_broadcast(rows.select("path", "mtime")), same).select(F.col("path").alias("p"), F.col("mtime").alias("m")).distinct())
            rows = rows.join(bounded_broadcast(known), (F.col("path") == F.col("p")) & F.col("mtime").eqNullSafe(F.col("m")), "left_anti")
        except AnalysisException:
            pass
    out = clean_pages(rows, "text").select(*COLUMNS).write
    out.mode("append").parquet(f"{table}/batch=-1") if batch_id is None else out.mode("overwrite").parquet(f"{table}/batch={batch_id}")


def latest_cleaned(spark: SparkSession, table: str) -> DataFrame:
    """The table with the newest version of each file. Only paths, times and batch numbers travel to find the versions that were replaced."""
    rows = spark.read.parquet(table)
    versions = rows.groupBy("path").agg(F.max(F.struct("mtime", "batch")).alias("v"), F.count("*").alias("n")).where("n > 1").select(F.col("path").alias("p"), "v")
    kept = rows.join(bounded_broadcast(cut(versions)), F.col("path") == F.col("p"), "left").where(F.col("v").isNull() | (F.struct("mtime", "batch") == F.col("v")))
    return kept.select(*COLUMNS)


def clean_arrivals(spark: SparkSession, folder: str, table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Starts the stream; with ``once`` it takes all that is there and stops."""
    writer = arriving_markdown(spark, folder).writeStream.foreachBatch(lambda batch, number: add_cleaned(batch, table, number)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def status_counts(events: DataFrame, ts: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by kind in event-time windows; rows later than the watermark are left out of a stream's result."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, window).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "kind", "n")
