"""File scans: discovery of tree files, Markdown and office folders, and tolerant decoding.

Listings read file metadata only; the content column is pruned unless asked for.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from leafmill.functions import text as T


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def list_files(spark: SparkSession, folder: str, recursive: bool = True, content: bool = False, glob: str | None = None) -> DataFrame:
    """(path, rel_path, size, mtime[, content]) of the files of a folder; none for a folder that is missing or empty. Order by ``path`` where order matters."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(folder)
    except AnalysisException:
        df = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    root = folder.rstrip("/") + "/"
    rel = F.substring(F.col("path"), F.locate(root, F.col("path")) + len(root), F.length("path"))
    out = df.select("path", rel.alias("rel_path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), *(["content"] if content else []))
    return out if recursive else out.where(~F.contains("rel_path", F.lit("/")))


def tree_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, basename, mtime, place): the ``*.json`` files of a folder that don't start with ``_``, numbered by lower-case name."""
    from leafmill.operators.ranking import ranked

    files = list_files(spark, folder, recursive=False, glob="*.json").select("path", base_name(F.col("path")).alias("basename"), "mtime")
    return ranked(files.where(~F.startswith("basename", F.lit("_"))), [F.lower("basename"), F.col("basename")], out="place")


def resolve_trees(spark: SparkSession, given: str | None, collection: str, preferred: str, fallback: str) -> list[str]:
    """The tree files to export: a given file, else the files of a given folder, else those of the default collection, else the preferred file, else
    the newest ``*page_tree*.json`` of the fallback folder. A given path that is neither falls through to the defaults; a given folder without
    files gives none."""
    is_file = lambda p: path_kind(spark, p) == "file"
    if given and (kind := path_kind(spark, given)):
        return [given] if kind == "file" else _ordered(tree_files(spark, given))
    found = _ordered(tree_files(spark, collection))
    if found:
        return found
    if is_file(preferred):
        return [preferred]
    newest = list_files(spark, fallback, recursive=False, glob="*page_tree*.json").orderBy(F.desc("mtime"), "path").select("path").limit(1)
    return [r[0] for r in newest.collect()]


def _ordered(files: DataFrame) -> list[str]:
    return [r[0] for r in files.orderBy("place").select("path").collect()]


def path_kind(spark: SparkSession, path: str) -> str:
    """``file``, ``folder`` or the empty text, on any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return "" if not fs.exists(at) else "file" if fs.getFileStatus(at).isFile() else "folder"


def tolerant_utf8(content: Column) -> Column:
    """Bytes as UTF-8 with U+FFFD for bad ones."""

    @F.pandas_udf(StringType())
    def decode(parts):
        return parts.map(lambda b: None if b is None else bytes(b).decode("utf-8", "replace"))

    return decode(content)


def markdown_files(spark: SparkSession, folder: str, most_bytes: int | None = None) -> DataFrame:
    """(rel_path, text) of all Markdown files below a folder; with ``most_bytes`` larger ones aren't read."""
    files = list_files(spark, folder, content=True, glob="*.md")
    if most_bytes is not None:
        files = files.where(F.col("size") <= most_bytes)
    return files.select("rel_path", tolerant_utf8(F.col("content")).alias("text"))


def typed_files(spark: SparkSession, folder: str, extensions: list[str]) -> DataFrame:
    """(rel_path, size, mtime) of the files with one of the extensions (without dots), in any case."""
    files = list_files(spark, folder)
    return files.where(F.regexp_replace(T.extension(F.col("rel_path")), r"\A\.", "").isin(extensions)).select("rel_path", "size", "mtime")
