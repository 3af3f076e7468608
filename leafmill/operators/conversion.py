"""Office-file conversion: routing, model assignment, text normalisation, status and failure tables.

Deviations that are meant: assignment is by path order instead of thread timing, output paths that collide are flagged instead of overwritten, and the
conversion date is a parameter.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.ranking import ranked

#: Extension classes.
MODERN = ["docx", "pptx", "xlsx", "pdf", "png"]
LEGACY = {"doc": "docx", "xls": "xlsx", "ppt": "pptx"}
DIRECT = [*MODERN, "md", "txt", "jpg", "jpeg"]
VIDEO = ["avi", "mp4", "mov", "mkv", "webm", "wmv", "flv", "m4v"]
AUDIO = ["mp3", "wav", "m4a", "aac", "flac", "ogg", "opus", "wma", "aiff", "au"]
MODELS = ["vision-s", "vision-m", "layout-x"]


def routed(df: DataFrame, path: str) -> DataFrame:
    """Adds ``ext``, ``route`` (skip_media, skip_xmind, legacy, direct, unsupported), ``file_type`` and ``trace``."""
    ext = F.regexp_replace(T.extension(F.col(path)), r"\A\.", "")
    df = df.withColumn("ext", ext)
    e = F.col("ext")
    route = F.when(e.isin(VIDEO + AUDIO), "skip_media").when(e == "xmind", "skip_xmind").when(e.isin(list(LEGACY)), "legacy").when(e.isin(DIRECT), "direct").otherwise("unsupported")
    to = F.lit(None).cast("string")
    for old, new in LEGACY.items():
        to = F.when(e == old, new).otherwise(to)
    df = df.withColumn("route", route).withColumn("file_type", F.when(F.col("route") == "legacy", to).when(F.col("route") == "direct", e))
    trace = (
        F.when(F.col("route") == "skip_media", "skip_audio_video").when(F.col("route") == "skip_xmind", "skip_xmind")
        .when(F.col("route") == "legacy", F.concat(F.lit("legacy_convert:."), e, F.lit("->"), "file_type")).when(F.col("route") == "direct", "direct").otherwise("")
    )
    return df.withColumn("trace", trace)


def assigned(df: DataFrame, path: str, models: list[str] | None = None) -> DataFrame:
    """Adds ``model``: the pool's models in turn, in path order, over all files that aren't skipped (unsupported ones take a turn too)."""
    pool = F.array(*[F.lit(m) for m in models or MODELS])
    kept = ranked(df.where(~F.col("route").startswith("skip_")), [F.col(path)], out="__turn", start=0)
    kept = kept.withColumn("model", F.element_at(pool, (F.col("__turn") % F.size(pool) + 1).cast("int"))).drop("__turn")
    return kept.unionByName(df.where(F.col("route").startswith("skip_")).withColumn("model", F.lit(None).cast("string")))


def output_collisions(df: DataFrame, path: str) -> DataFrame:
    """(output_file, n_sources): Markdown paths that more than one source would write."""
    return df.select(path).distinct().groupBy(T.markdown_path(F.col(path)).alias("output_file")).agg(F.count("*").alias("n_sources")).where("n_sources > 1")


def converter_text(*candidates: Column) -> Column:
    """The first candidate that isn't blank, as it is; the empty text if all are."""
    return F.coalesce(*[F.when(T.strip(c) != "", c) for c in candidates], F.lit(""))


def table_lines(x: Column) -> Column:
    """Table lines in one form: outer pipes dropped (leading empty cells vanish), cells trimmed, delimiter cells without spaces; other lines right-stripped.

    Any line with a pipe that doesn't open a fence counts as a table line, also inside of fences.
    """

    def line(raw: Column) -> Column:
        inner = F.regexp_replace(T.strip(raw), r"\A\|+|\|+\z", "")
        cells = F.transform(F.split(inner, r"\|", -1), lambda c: T.strip(c))
        rule = F.forall(cells, lambda c: c.rlike(r"(?U)\A[:\-\s]+\z"))
        shown = F.when(rule, F.transform(cells, lambda c: F.replace(c, F.lit(" "), F.lit("")))).otherwise(cells)
        is_table = F.contains(raw, F.lit("|")) & ~F.startswith(T.strip(raw), F.lit("```"))
        return F.when(is_table, F.concat(F.lit("| "), F.array_join(shown, " | "), F.lit(" |"))).otherwise(T.rstrip(raw))

    return F.array_join(F.transform(T.split_lines(x), line), "\n")


def with_front_matter(body: Column, source: Column, file_type: Column, date: str, model: Column) -> Column:
    clean = T.lstrip_newlines(F.regexp_replace(body, r"\A\ufeff+", ""))
    head = F.concat(
        F.lit("---\nsource_file: "), T.yaml_quoted(source), F.lit("\nfile_type: "), T.yaml_quoted(file_type), F.lit("\nconversion_date: "), T.yaml_quoted(F.lit(date)), F.lit("\nused_llm_model: "), T.yaml_quoted(model), F.lit("\n---\n\n")
    )
    return F.concat(head, clean)


def cleaned_conversion(df: DataFrame, text: str, source: str, file_type: str, model: str, date: str, out: str = "markdown") -> DataFrame:
    """Squeeze, table lines, squeeze, front matter, one final line end."""
    df = df.withColumn(out, T.squeezed(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn(out, table_lines(F.col(out))).withColumn(out, T.squeezed(F.col(out)))
    df = df.withColumn(out, with_front_matter(F.col(out), F.col(source), F.col(file_type), date, F.col(model)))
    return df.withColumn(out, F.concat(T.rstrip(F.col(out)), F.lit("\n")))


def converted(df: DataFrame, path: str, content: str, converter: Callable[[str, bytes], str], upgrade: Callable[[str, bytes], tuple[str, bytes]] | None = None) -> DataFrame:
    """Runs an injected converter over routed files, Arrow-batched: ``text``, ``status`` (ok, skipped, failed), ``error`` and ``elapsed_sec``; a failing file fails alone.

    Legacy files go through ``upgrade`` first, which gives the modern file's name and bytes; without one the converter gets them as they are. The other columns of ``df`` but the content come out too.
    """
    kept = [c for c in df.columns if c != content]

    def run(batches):
        for pdf in batches:
            texts, states, errors, seconds = [], [], [], []
            for name, body, route in zip(pdf[path], pdf[content], pdf["route"]):
                began = time.monotonic()
                if route.startswith("skip_"):
                    row = (None, "skipped", None)
                elif route == "unsupported":
                    row = (None, "failed", "unsupported file type")
                else:
                    try:
                        if route == "legacy" and upgrade:
                            name, body = upgrade(name, body)
                        row = (converter(name, body), "ok", None)
                    except Exception as e:  # noqa: BLE001 - the converter's failure is the file's status
                        row = (None, "failed", str(e))
                texts.append(row[0])
                states.append(row[1])
                errors.append(row[2])
                seconds.append(round(time.monotonic() - began, 3))
            yield pd.DataFrame({**{c: pdf[c] for c in kept}, "text": texts, "status": states, "error": errors, "elapsed_sec": seconds})

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
    return df.mapInPandas(run, f"{types}, text string, status string, error string, elapsed_sec double")


def status_summary(results: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Counts by status, over all or by groups; ``failed_run`` says whether any failed."""
    return results.groupBy(*(groups or [])).agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.count_if(F.col("status") == "failed").alias("failed"), F.bool_or(F.col("status") == "failed").alias("failed_run")
    )


def failure_log(results: DataFrame) -> DataFrame:
    """Rows of the failure log; seconds to three places."""
    return results.where(F.col("status") == "failed").select("source_file", "used_llm_model", "status", "error", "preprocess_trace", F.round("elapsed_sec", 3).alias("elapsed_sec"), F.col("logged_at").alias("timestamp"))


def joined_chunks(chunks: DataFrame) -> DataFrame:
    """(stream_id, content, reasoning): streamed pieces joined in order; null pieces add nothing."""
    return chunks.groupBy("stream_id").agg(
        *[F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.coalesce(c, F.lit("")).alias("v")))), lambda s: s["v"]), "").alias(c) for c in ("content", "reasoning")]
    )
