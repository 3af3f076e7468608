"""Retrieval over the finished corpus: items, chunks, embeddings, cosine top-k, one-hop relations, and their fusion.

Chunking and fusion are this engine's own design: chunks of ``size`` characters that overlap by ``overlap``; ranks fused by reciprocal rank.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import text as T

PLAIN, INGESTED = ["md", "txt"], ["md", "pdf", "docx", "xlsx", "txt"]
#: Vectors compared with all queries at once in a task.
BLOCK = 4096
#: Queries that are compared at once: a larger set is taken in so many blocks.
QUERY_BLOCK = 10_000


def plain_items(docs: DataFrame, doc: str, text: str, file_type: str) -> DataFrame:
    """(doc, items): content items of plain-text documents; other types are left out. Null texts give an item with the empty text."""
    item = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(0).alias("page_idx"))
    return docs.where(F.lower(file_type).isin(PLAIN)).select(F.col(doc).alias("doc"), F.array(item).alias("items"))


def ingestible(docs: DataFrame, file_type: str) -> DataFrame:
    return docs.where(F.lower(file_type).isin(INGESTED))


def questions(lines: DataFrame, order: str, line: str) -> DataFrame:
    """The lines up to the first ``exit`` or ``quit`` (in any case), stripped, blank ones skipped."""
    rows = lines.select(F.col(order).alias("o"), T.strip(F.coalesce(line, F.lit(""))).alias("question"))
    stop = rows.agg(F.min(F.when(F.lower("question").isin("exit", "quit"), F.col("o"))).alias("stop"))
    return rows.crossJoin(F.broadcast(stop)).where("(stop IS NULL OR o < stop) AND question <> ''").select(F.col("o").alias(order), "question")  # stop is one row


def chunks(docs: DataFrame, doc: str, text: str, size: int = 1200, overlap: int = 100) -> DataFrame:
    """(doc, chunk_no, chunk): overlapping stretches of each text; null and empty texts have none."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - overlap - 1, F.lit(0)), F.lit(step))
    rows = docs.where(F.length(text) > 0).select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.posexplode(starts).alias("chunk_no", "at"))
    return rows.select("doc", "chunk_no", F.substring(F.col("t"), F.col("at") + 1, F.lit(size)).alias("chunk"))


def embedded(df: DataFrame, text: str, embed: Callable[[list[str]], list[list[float]]], out: str = "embedding") -> DataFrame:
    """Adds the vectors of an injected embedding function, Arrow-batched."""

    from pyspark.sql.types import ArrayType, FloatType

    @F.pandas_udf(ArrayType(FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(embed([t or "" for t in texts]))

    return df.withColumn(out, run(F.col(text)))


def hashed_embedding(texts: list[str], size: int = 64) -> list[list[float]]:
    """A deterministic stand-in for an embedding service: hashed character trigrams, of length 1."""
    import zlib

    out = []
    for t in texts:
        v = np.zeros(size)
        for i in range(max(0, len(t) - 2)):
            h = zlib.crc32(t[i : i + 3].encode())
            v[h % size] += 1 if h & 0x10000 else -1
        n = np.linalg.norm(v)
        out.append((v / n if n else v).astype(np.float32).tolist())
    return out


def cosine_top_k(vectors: DataFrame, vec_id: str, vector: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, vec_id, score, rank): each query's ``k`` nearest other vectors by cosine; ties by id. Ranks follow the full score, which comes out to 6 places.

    Queries (``query_id, vector``) are dealt into blocks of about QUERY_BLOCK; each block is sent to all tasks in its turn, the vectors stay where they are, and each task passes on its own
    best ``k``. Null and zero vectors and those of another size have no score.
    """
    asked = queries.where(F.col("vector").isNotNull())
    blocks = -(-asked.count() // QUERY_BLOCK) or 1
    every = None
    for i in range(blocks):
        part = _block_top_k(vectors, vec_id, vector, asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i), k)
        every = part if every is None else every.unionByName(part)
    return every


def _block_top_k(vectors: DataFrame, vec_id: str, vector: str, queries: DataFrame, k: int) -> DataFrame:
    asked = queries.collect()  # one block
    ids = np.array([r["query_id"] for r in asked], dtype=np.int64)
    size = max((len(r["vector"]) for r in asked), default=0)
    matrix = np.array([r["vector"] if len(r["vector"]) == size else [0.0] * size for r in asked], dtype=np.float64).reshape(len(asked), size)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)))

    def run(batches):
        qid, q = shared.value
        best_s, best_v = np.full((len(qid), 0), -np.inf), np.zeros((len(qid), 0), dtype=np.int64)
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo in range(0, len(names), BLOCK):
                rows = batch.column(1).slice(lo, BLOCK).to_pylist()
                good = [i for i, r in enumerate(rows) if r is not None and len(r) == q.shape[1] and None not in r]
                if not good or not len(qid):
                    continue
                x = np.array([rows[i] for i in good], dtype=np.float64)
                n = np.linalg.norm(x, axis=1, keepdims=True)
                v = names[lo : lo + BLOCK][good]
                s = q @ np.divide(x, n, out=np.zeros_like(x), where=n > 0).T
                s[:, (n == 0).ravel()] = -np.inf
                s[qid[:, None] == v[None, :]] = -np.inf
                best_s = np.concatenate([best_s, s], axis=1)
                best_v = np.concatenate([best_v, np.broadcast_to(v, s.shape)], axis=1)
                order = np.lexsort((best_v, -best_s), axis=1)[:, :k]
                best_s, best_v = np.take_along_axis(best_s, order, 1), np.take_along_axis(best_v, order, 1)
        keep = np.isfinite(best_s)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, keep.sum(axis=1))), pa.array(best_v[keep]), pa.array(best_s[keep])], names=["query_id", "vec_id", "score"])

    near = vectors.select(F.col(vec_id).cast("long"), vector).mapInArrow(run, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows a task
    return near.withColumn("rank", place).where(F.col("rank") <= k).withColumn("score", F.round("score", 6))


def one_hop(relations: DataFrame, seeds: DataFrame) -> DataFrame:
    """(query_id, vec_id, hops): the neighbours of each query's seeds. ``relations``: source, target; ``seeds``: query_id, vec_id."""
    both = relations.select("source", "target").unionByName(relations.select(F.col("target").alias("source"), F.col("source").alias("target")))
    return seeds.join(both, F.col("vec_id") == F.col("source")).groupBy("query_id", F.col("target").alias("vec_id")).agg(F.count("*").alias("hops"))


def fused(lists: list[DataFrame], k: int = 10, damping: int = 60) -> DataFrame:
    """(query_id, vec_id, fused_score, rank): reciprocal-rank fusion of ranked lists (query_id, vec_id, rank)."""
    every = lists[0].select("query_id", "vec_id", "rank")
    for other in lists[1:]:
        every = every.unionByName(other.select("query_id", "vec_id", "rank"))
    score = every.groupBy("query_id", "vec_id").agg(F.round(F.sum(1 / (F.col("rank") + damping)), 9).alias("fused_score"))
    return score.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("fused_score"), "vec_id"))).where(F.col("rank") <= k)


def answered(df: DataFrame, question: str, context: str, complete: Callable[[str, str], str], out: str = "answer") -> DataFrame:
    """Adds the answers of an injected completion function, Arrow-batched."""
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def run(q: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([complete(a or "", b or "") for a, b in zip(q, c)])

    return df.withColumn(out, run(F.col(question), F.col(context)))


def checked_key(name: str, value: str | None, placeholders: tuple[str, ...] = ("", "your-key", "changeme")) -> str:
    """A credential setting, refused if missing or a placeholder."""
    if value is None or value.strip().lower() in placeholders:
        raise ValueError(f"{name} isn't set")
    return value


def parser_for(registry: dict[str, Callable], name: str | None, default: str = "plaintext") -> Callable:
    """The parser registered under a name."""
    key = (name or default).strip().lower()
    if key not in registry:
        raise ValueError(f"no parser named {key!r}; there are {sorted(registry)}")
    return registry[key]


