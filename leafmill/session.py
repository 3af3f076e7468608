"""Session helpers: a tuned builder, the shared checkpoint folder, and test-table access."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A session with the settings the engine expects (UTC, AQE, Arrow). On a cluster use the given session instead."""
    return (
        SparkSession.builder.master(master)
        .appName("leafmill")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``. Where it is unset, a local master (tests, benches) gets a folder of its own; on a cluster that is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir")
    if not shared and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir isn't set: it must name a folder that all executors share")
    sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "leafmill-checkpoints"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the workers, wherever they run: once per application a zip of its modules goes out through Spark."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="leafmill-"), "leafmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def spread(df: DataFrame) -> DataFrame:
    """A plain scan with at least one partition a core: small inputs, often one row group, are dealt out before Python work; inputs that have enough
    splits of their own aren't shuffled."""
    plan, cores = df._jdf.queryExecution().executedPlan(), df.sparkSession.sparkContext.defaultParallelism
    if plan.nodeName() == "AdaptiveSparkPlan":  # it has shuffles of its own
        return df
    return df.repartition(cores) if plan.execute().getNumPartitions() < cores else df


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so that a lost executor does not lose the intermediate table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder with one Parquet file or directory per table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
