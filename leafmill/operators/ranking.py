"""Global ranks without a single-task window, and bounded helpers shared by the operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import cut

#: A side is broadcast only if it has at most this many rows.
BROADCAST_ROWS = 200_000
#: Hot keys of a join that are broadcast, at most.
HOT_KEYS = 20_000


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (then the planner shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str, rows: int = HOT_KEYS) -> DataFrame:
    """``left`` joined with ``right``, which has one row a key and in ``n`` how many rows of ``left`` have the key (``right`` is read several times: pass a stored one).

    Keys that hold at least the ``rows``-th part of what is counted are at most ``rows`` many; they are joined by broadcast, so no hot key meets in one task. The others are joined by shuffle,
    with few rows each.
    """
    found, total = right.agg(F.count("*"), F.coalesce(F.sum(n), F.lit(0))).first()
    if found <= rows:
        return left.join(F.broadcast(right), keys)
    bound = total // rows + 1
    return left.join(F.broadcast(right.where(F.col(n) >= bound)), keys).unionByName(left.join(right.where(F.col(n) < bound), keys))


def distinct_texts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``df`` with one row of each (keys, text), extra columns of one of them. Of files only keys and 128-bit digests travel: the rows that repeat are found by digest and, by
    their place in the files, all but the first are dropped where they are read. Other frames are deduplicated as they are.
    """
    try:
        placed = df.withColumn("__place", F.struct("_metadata.file_path", F.col("_metadata.row_index").alias("row")))
        placed.schema
    except AnalysisException:
        return df.dropDuplicates([*keys, text])
    digest = F.unhex(F.md5(F.col(text).cast("binary")))
    small = placed.select(*keys, digest.alias("__digest"), "__place").groupBy(*keys, "__digest").agg(F.count("*").alias("n"), F.min("__place").alias("__first"))
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    twice = cut(small.where("n > 1").select(*[F.col(k).alias(n) for k, n in names.items()], F.col("__digest").alias("__d"), "__first"))
    if twice.isEmpty():
        return df
    on = digest.eqNullSafe(F.col("__d"))
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    kept = placed.join(bounded_broadcast(twice), on, "left").where(F.col("__first").isNull() | (F.col("__first") == F.col("__place")))
    return kept.select(*df.columns)


def ranked(df: DataFrame, order: list[Column], groups: list[str] | None = None, out: str = "rank", start: int = 1) -> DataFrame:
    """Adds the row's number in ``order``, counted within ``groups`` (or over all rows).

    Rows are range-sorted; each partition counts its own rows, and the counts before it are added through a table of one row per group and partition. So
    neither a huge group nor the whole table passes through one task.
    """
    groups = groups or []
    keys = [F.col(g) for g in groups]
    flat = df.withColumn("__o", F.struct(*order))
    parts = flat.repartitionByRange(*keys, "__o").sortWithinPartitions(*keys, "__o")
    local = parts.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    local = cut(local)
    same = [F.col(f"__g{i}") for i in range(len(groups))]
    counts = local.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__p").alias("__q")).agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*same).orderBy("__q").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("__base", F.coalesce(before, F.lit(0)) - F.col("__first"))
    on = F.col("__p") == F.col("__q")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = local.join(bounded_broadcast(counts.drop("__n", "__first")), on)
    return joined.withColumn(out, (F.col("__base") + F.col("__i") + start).cast("long")).select(*df.columns, out)
