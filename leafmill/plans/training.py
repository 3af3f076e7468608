"""Queries of the general training-data operator of the core (mixed timestamps)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.operators.timestamps import found_instants, normalise_timestamps
from leafmill.session import table


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return found_instants(table(spark, folder, "page_meta"), table(spark, folder, "page_trees"))


def p5_normalised(spark: SparkSession, folder: str) -> DataFrame:
    """All metadata rows with their instant (null where the text denotes none)."""
    trees = table(spark, folder, "page_trees").select("tree_id", "locale", "tz").dropDuplicates(["tree_id"])
    meta = table(spark, folder, "page_meta").join(trees, "tree_id", "left")
    return normalise_timestamps(meta, "last_modified", "locale", "tz", "extracted_at").select("meta_id", "page_id", "tree_id", "last_modified", "epoch_us")


QUERIES = {"p5_found": p5_found, "p5_normalised": p5_normalised}
