"""Mixing sources to target weights.

Method: a time-varying curriculum. Each source has a piecewise linear weight schedule over training time 0..1; its integral times the
token budget is the source's cumulative demand. A source's documents, in a fixed pseudo-random order and repeated as long as the
demand asks and ``max_repeats`` allows, form its supply; inverting the demand at the supply's running token count gives
each copy its training position, and the mix is range-sorted by position. A source is short if the inverse of its demand at its whole supply
(``max_repeats`` times its size) lies before the end, that is if it runs out. Schedules are a table, joined by source.

Running token counts are taken in two levels (hash buckets, then rows within a bucket), so no source is gathered
in one task. Defined results: sources without documents have size 0 and are short if their weight is positive; null and empty texts have
no tokens and are left out of the mix; documents of sources that aren't listed are left out; null weights and repeats
count as 0; of repeated target rows the largest weight and repeats count; repeated document rows count each.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.encoding import count_tokens
from leafmill.operators.ranking import bounded_broadcast
from leafmill.session import cut

#: More target rows than this are joined without a broadcast hint.
BROADCAST_ROWS = 10_000
#: Documents per running-count bucket, on average.
BUCKET_ROWS = 20_000


def normal_schedule(knots: list[tuple[float, float]]) -> list[tuple[float, float, float]]:
    """(time, factor, integral so far) with the integral over 0..1 scaled to 1."""
    knots = sorted(knots)
    if len(knots) < 2 or knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs knots at times 0 and 1 and factors of 0 or more")
    areas = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        areas.append(areas[-1] + (t1 - t0) * (w0 + w1) / 2)
    if areas[-1] <= 0:
        raise ValueError("a schedule's factors can't all be 0")
    return [(t, w / areas[-1], a / areas[-1]) for (t, w), a in zip(knots, areas)]


def segments(schedules: DataFrame) -> DataFrame:
    """(source, segments) of (source, knots): the pieces of each schedule's demand that grow, with time, factor and integral at both ends."""

    def run(batches):
        for batch in batches:
            found = []
            for knots in batch.column(1).to_pylist():
                made = normal_schedule([(k["at"], k["factor"]) for k in knots])
                found.append([dict(zip(("t0", "w0", "a0", "t1", "w1", "a1"), (*x, *y))) for x, y in zip(made, made[1:]) if y[2] > x[2]])
            kind = pa.list_(pa.struct([(n, pa.float64()) for n in ("t0", "w0", "a0", "t1", "w1", "a1")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["source", "segments"])

    one = schedules.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("knots").alias("knots"))
    return one.mapInArrow(run, f"source string, segments {_SEGMENTS}")


_SEGMENTS = "array<struct<t0: double, w0: double, a0: double, t1: double, w1: double, a1: double>>"


def invert(share: Column, pieces: Column) -> Column:
    """The time at which a schedule's integral reaches ``share``; 1 from its whole demand on."""
    x = F.get(F.filter(pieces, lambda s: share < s["a1"]), F.lit(0))
    slope, need = (x["w1"] - x["w0"]) / (x["t1"] - x["t0"]), share - x["a0"]
    bent = F.try_divide(2 * need, F.sqrt(F.greatest(F.lit(0.0), x["w0"] * x["w0"] + 2 * slope * need)) + x["w0"])
    return F.when(x.isNull(), 1.0).otherwise(x["t0"] + F.coalesce(F.when(slope == 0, F.try_divide(need, x["w0"])).otherwise(bent), F.lit(0.0)))


def _as_table(spark: SparkSession, schedules: DataFrame | dict | None) -> DataFrame | None:
    if not isinstance(schedules, dict):
        return schedules
    for knots in schedules.values():
        normal_schedule(knots)  # refuses wrong ones at once
    rows = [(s, [(float(t), float(w)) for t, w in knots]) for s, knots in schedules.items()]
    return spark.createDataFrame(rows, "source string, knots array<struct<at: double, factor: double>>")


def source_sizes(docs: DataFrame, targets: DataFrame, schedules: DataFrame | dict | None = None, vocabulary: str | None = None, size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents of target sources with n_tokens, report by source: sizes, demand, supply, schedule, and ``runs_out``, the position at which the whole supply is used up).

    A source whose supply lasts to the end of its demand runs out at 1. ``size`` replaces the token count.
    """
    goals = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max(F.coalesce("target_weight", F.lit(0.0))).alias("target_weight"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats"))
    few = goals.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hint = F.broadcast if few else (lambda x: x)
    wanted = docs.select("doc_id", "source", "text").join(hint(goals.select("source")), "source", "left_semi")
    if size is None:
        counted = cut(count_tokens(wanted, "text", ["doc_id", "source"], vocabulary))
    else:
        counted = wanted.select("doc_id", "source", F.coalesce(size, F.lit(0)).cast("long").alias("n_tokens"))
    sizes = counted.groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count("*").alias("n_docs"))
    report = goals.join(hint(sizes) if few else sizes, "source", "left").withColumn("size", F.coalesce("size", F.lit(0))).withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    total = F.sum("size").over(Window.partitionBy(F.lit(0)))  # one row per target source
    report = report.withColumn("budget", total).withColumn("demand", F.col("target_weight") * F.col("budget")).withColumn("supply", F.col("max_repeats") * F.col("size"))
    constant = F.expr(f"CAST(array(struct(0.0D, 1.0D, 0.0D, 1.0D, 1.0D, 1.0D)) AS {_SEGMENTS})")
    plans = _as_table(docs.sparkSession, schedules)
    if plans is None:
        report = report.withColumn("segments", constant)
    else:
        report = report.join(hint(segments(plans)) if few else segments(plans), "source", "left").withColumn("segments", F.coalesce("segments", constant))
    report = report.withColumn("runs_out", F.when(F.col("demand") > 0, invert(F.col("supply") / F.col("demand"), F.col("segments"))).otherwise(1.0))
    return counted, report.withColumn("is_short", F.col("runs_out") < 1)


def mix(docs: DataFrame, targets: DataFrame, schedules: DataFrame | dict | None = None, vocabulary: str | None = None, size: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies: doc_id, source, copy, n_tokens, position — sorted by position; report of sources).

    ``schedules``: a table (source, knots: list of at, factor), or a dictionary; sources without one have a constant weight.
    """
    counted, report = source_sizes(docs, targets, schedules, vocabulary, size)
    report = cut(report)
    counted = counted.where("n_tokens > 0")
    buckets, most_docs = 1, report.agg(F.max("n_docs")).first()[0] or 0
    while buckets * BUCKET_ROWS < most_docs:
        buckets *= 2
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    lead = F.conv(F.substring("__k", 1, 8), 16, 10).cast("long")
    rows = counted.withColumn("__k", key).withColumn("__b", F.shiftright(lead * buckets, 32))  # buckets follow the order of the keys
    totals = rows.groupBy("source", "__b").agg(F.sum("n_tokens").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("source").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("source", "__b", F.coalesce(before, F.lit(0)).alias("__base"))
    inner = Window.partitionBy("source", "__b").orderBy("__k", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(totals, ["source", "__b"])
    use = report.where("demand > 0").select("source", "size", "demand", "max_repeats", "segments")
    rows = rows.join(bounded_broadcast(use, BROADCAST_ROWS), "source")
    first = F.col("__base") + F.col("__in")
    most = F.least(F.col("max_repeats").cast("double"), F.ceil((F.col("demand") - first) / F.col("size"))).cast("int")
    rows = rows.withColumn("__first", first).withColumn("__copies", most).where("__copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    rows = rows.withColumn("__share", (F.col("__first") + F.col("copy") * F.col("size")) / F.col("demand"))
    copies = rows.select("doc_id", "source", "copy", "n_tokens", invert(F.col("__share"), F.col("segments")).alias("position"))
    return copies.orderBy("position", "source", "doc_id", "copy"), report


def shares(copies: DataFrame, report: DataFrame) -> DataFrame:
    """The shares that a mix reaches, by source."""
    used = copies.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), F.count("*").alias("n_copies"), (F.max("copy") + 1).alias("repeats"))
    out = report.join(used, "source", "left").na.fill(0, ["used_tokens", "n_copies", "repeats"])
    total = F.sum("used_tokens").over(Window.partitionBy(F.lit(0)))
    return out.withColumn("actual_share", F.when(total > 0, F.col("used_tokens") / total).otherwise(0.0)).select(
        "source", "target_weight", "max_repeats", "size", "budget", "is_short", "used_tokens", "n_copies", "repeats", "actual_share"
    )


def found_short(docs: DataFrame, targets: DataFrame, schedules: DataFrame | dict | None = None, vocabulary: str | None = None) -> DataFrame:
    """(source): the target sources whose supply runs out before the end of the curriculum."""
    return source_sizes(docs, targets, schedules, vocabulary)[1].where("runs_out < 1").select("source")
