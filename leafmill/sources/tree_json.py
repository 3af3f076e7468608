"""Nested tree JSON in and out. A document ``{id, title, type, slug, children}`` becomes rows of a node table, and back."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree_id string, id string, parent_id string, pos int, title string, node_type string, slug string"


def flatten(tree_id: str, text: str | None) -> list[tuple]:
    """The node rows of one document; none for text that isn't a JSON object with an id. Depth is limited by memory, not by the stack."""
    try:
        root = json.loads(text or "")
    except (ValueError, RecursionError):
        return []
    if not isinstance(root, dict) or not root.get("id"):
        return []
    out, stack = [], [(root, None, 0)]
    while stack:
        node, parent, pos = stack.pop()
        if not isinstance(node, dict) or node.get("id") is None:
            continue
        own = str(node["id"])
        out.append((tree_id, own, parent, pos, node.get("title") or f"page_{own}", node.get("type") or "page", node.get("slug")))
        stack.extend((c, own, i) for i, c in enumerate(node.get("children") or []))
    return out


def nodes_of(documents: DataFrame, tree_id: str, text: str) -> DataFrame:
    """The node table of documents that hold one tree each."""

    def run(batches):
        for pdf in batches:
            rows = [r for t, x in zip(pdf["t"], pdf["x"]) for r in flatten(t, x)]
            yield pd.DataFrame(rows, columns=["tree_id", "id", "parent_id", "pos", "title", "node_type", "slug"])

    return documents.select(F.col(tree_id).alias("t"), F.col(text).alias("x")).mapInPandas(run, NODES)


def read_trees(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The node table of tree files; the tree id is the file's stem."""
    texts = spark.read.text(paths, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.json)?$", 1).alias("stem"), "value")
    return nodes_of(texts, "stem", "value")


def nested(rows: list[dict]) -> dict:
    """One tree's nested document from its rows (id, parent_id, ord, title, node_type, slug), children in order."""
    made = {r["id"]: {"id": r["id"], "title": r["title"], "type": r["node_type"], "slug": r["slug"], "children": []} for r in rows}
    root = None
    for r in sorted(rows, key=lambda r: [(s["pos"], s["id"]) for s in r["ord"]]):
        if len(r["ord"]) == 1:
            root = made[r["id"]]
        else:
            made[r["ord"][-2]["id"]]["children"].append(made[r["id"]])
    return root or {}


def tree_documents(expanded: DataFrame) -> DataFrame:
    """(tree_id, json): the nested document of each tree, two spaces of indent, non-ASCII kept. A document is one string, so a tree is put together in one
    task, as its file would be."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [dict(zip(pdf.columns, v)) for v in pdf.itertuples(index=False)]
        return pd.DataFrame({"tree_id": [rows[0]["tree_id"]], "json": [json.dumps(nested(rows), ensure_ascii=False, indent=2)]})

    return expanded.select("tree_id", "id", "parent_id", "ord", "title", "node_type", "slug").groupBy("tree_id").applyInPandas(build, "tree_id string, json string")
