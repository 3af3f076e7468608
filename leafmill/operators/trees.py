"""Page trees as adjacency tables: expansion, order, reconciliation, resume, names and paths.

A node table has ``tree_id, id, parent_id, pos, title, node_type, slug``; a root table has ``tree_id, root_id``. Depth is not walked level by
level: each round of pointer doubling joins every unfinished node's path with the path of its current top, so a tree of depth d
takes log2(d) + 1 rounds. Joins are on (tree, id), where the other side has one row per key, so a hot parent only splits the larger side.

Defined results: repeated rows count once (least title, then slug, of differing ones); nodes whose parents are missing, empty, null or in a
cycle aren't reached from a root and don't come out; nodes of trees without a root row don't either; ties in ``pos`` are ordered by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators.ranking import bounded_broadcast, ranked
from leafmill.session import cut

#: Doubling rounds that are enough for any tree of up to 2**62 levels.
MOST_ROUNDS = 62
FAILED_SUFFIX = "_空"


def distinct_nodes(nodes: DataFrame) -> DataFrame:
    """One row per (tree_id, id), with the columns of the data model."""
    best = F.min(F.struct(F.coalesce("parent_id", F.lit("")).alias("parent_id"), F.coalesce("pos", F.lit(0)).alias("pos"), "title", "node_type", "slug")).alias("b")
    rows = nodes.where(F.col("id").isNotNull() & F.col("tree_id").isNotNull()).groupBy("tree_id", "id").agg(best)
    return rows.select("tree_id", "id", T.filled(F.col("b.parent_id")).alias("parent_id"), "b.pos", "b.title", F.coalesce("b.node_type", F.lit("page")).alias("node_type"), "b.slug")


def expand(nodes: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All nodes reached from the roots, with ``depth`` (root 0), ``ids`` and ``ord`` (ids and (pos, id) pairs from the root down).

    With ``max_depth`` nodes deeper than that are left out; nodes at the limit stay, as leaves.
    """
    one = distinct_nodes(nodes)
    tops = roots.where(F.col("root_id").isNotNull()).select("tree_id", F.col("root_id").alias("id"), F.lit(True).alias("is_root")).distinct()
    rows = one.join(bounded_broadcast(tops), ["tree_id", "id"], "left")
    step = F.array(F.struct(F.col("pos").cast("int").alias("pos"), F.col("id").alias("id")))
    rows = rows.select("tree_id", "id", "parent_id", "pos", "title", "node_type", "slug", F.when(F.col("is_root"), F.lit(None)).otherwise(F.col("parent_id")).alias("top"), F.coalesce("is_root", F.lit(False)).alias("done"), step.alias("ord"))
    rows = cut(rows.where(F.col("done") | F.col("top").isNotNull()))
    open_before = None
    for _ in range(MOST_ROUNDS):
        active = rows.where(~F.col("done"))
        n = active.count()
        if n == 0 or n == open_before:
            break
        open_before = n
        above = rows.select(F.col("tree_id").alias("t"), F.col("id").alias("a"), F.col("top").alias("up"), F.col("done").alias("up_done"), F.col("ord").alias("up_ord"))
        moved = active.join(above, (F.col("tree_id") == F.col("t")) & (F.col("top") == F.col("a")))
        moved = moved.select("tree_id", "id", "parent_id", "pos", "title", "node_type", "slug", F.col("up").alias("top"), F.col("up_done").alias("done"), F.concat("up_ord", "ord").alias("ord"))
        rows = cut(rows.where("done").unionByName(moved))
        if max_depth is not None:
            rows = rows.where(F.size("ord") <= max_depth + 1)
    out = rows.where("done").select("tree_id", "id", "parent_id", "pos", "title", "node_type", "slug", (F.size("ord") - 1).alias("depth"), F.col("ord.id").alias("ids"), "ord")
    return out if max_depth is None else out.where(F.col("depth") <= max_depth)


def with_snapshot_below(expanded: DataFrame, snapshot: DataFrame, max_depth: int) -> DataFrame:
    """Nodes for a second expansion: those of one that was cut at ``max_depth``, and below the nodes at the limit what a snapshot knows. Snapshot children of nodes above the
    limit, which the expansion knows better, are left out."""
    kept = expanded.select("tree_id", "id", "parent_id", "pos", "title", "node_type", "slug", "depth")
    above = kept.where(F.col("depth") < max_depth).select("tree_id", F.col("id").alias("parent_id"))
    old = distinct_nodes(snapshot).where(F.col("parent_id").isNotNull()).join(kept.select("tree_id", "id"), ["tree_id", "id"], "left_anti").join(above, ["tree_id", "parent_id"], "left_anti")
    return kept.drop("depth").unionByName(old)


def subtree(expanded: DataFrame, root_id: str) -> DataFrame:
    """The nodes at and under one node, which becomes a root of depth 0."""
    at = F.array_position("ids", root_id)
    inside = expanded.where(at > 0)
    return inside.select(*[c for c in expanded.columns if c not in ("depth", "ids", "ord")], (F.col("depth") - at + 1).cast("int").alias("depth"), F.slice("ids", at.cast("int"), F.size("ids")).alias("ids"), F.slice("ord", at.cast("int"), F.size("ord")).alias("ord"))


def preorder(expanded: DataFrame, out: str = "preorder") -> DataFrame:
    """Adds the node's number in its tree's pre-order walk, from 1."""
    return ranked(expanded, [F.col("ord")], ["tree_id"], out)


def contains_id(expanded: DataFrame, wanted: str) -> DataFrame:
    """(tree_id, contains): whether a tree holds an id."""
    return expanded.groupBy("tree_id").agg(F.bool_or(F.col("id") == wanted).alias("contains"))


def child_sets(nodes: DataFrame, name: str) -> DataFrame:
    """(tree_id, parent_id, <name>_ids, <name>_n): distinct child ids in order, and the number of children."""
    return nodes.where(F.col("parent_id").isNotNull() & F.col("id").isNotNull()).groupBy("tree_id", "parent_id").agg(F.array_sort(F.collect_set("id")).alias(f"{name}_ids"), F.count("*").alias(f"{name}_n"))


def reconcile(api: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Children of the API with their snapshot state: ``kept`` (in both, snapshot title), ``new`` (API only), ``dropped`` (snapshot only).

    Order is the API's; dropped nodes have no position. Repeated snapshot ids: the one of the greatest position counts.
    """
    now = distinct_nodes(api).where(F.col("parent_id").isNotNull())
    last = F.max_by(F.struct("title", "node_type", "slug"), F.struct(F.coalesce("pos", F.lit(-1)), F.coalesce("title", F.lit("")))).alias("s")
    then = snapshot.where(F.col("parent_id").isNotNull() & F.col("id").isNotNull()).groupBy("tree_id", "parent_id", "id").agg(last)
    both = now.alias("n").join(then.alias("t"), ["tree_id", "parent_id", "id"], "full")
    state = F.when(F.col("n.pos").isNull(), "dropped").when(F.col("t.s").isNull(), "new").otherwise("kept")
    pick = lambda c: F.when(F.col("t.s").isNotNull(), F.col(f"t.s.{c}")).otherwise(F.col(f"n.{c}"))
    return both.select("tree_id", "parent_id", "id", F.col("n.pos").alias("pos"), pick("title").alias("title"), pick("node_type").alias("node_type"), pick("slug").alias("slug"), state.alias("state"))


def fetch_plan(api: DataFrame, snapshot: DataFrame, enabled: bool = True) -> DataFrame:
    """(tree_id, parent_id, n_children, fast, title): whether a parent's own page must be fetched again.

    ``fast`` if the snapshot has the same child ids and as many children (only below the root level of a known snapshot, and if enabled); then the snapshot's
    title is kept, which may be stale. Otherwise the fetched title counts, ``page_<id>`` where it is missing or empty.
    """
    sets = child_sets(distinct_nodes(api), "api").join(child_sets(snapshot.where(F.col("id") != ""), "snap"), ["tree_id", "parent_id"], "left")
    fast = F.lit(enabled) & F.coalesce((F.col("api_ids") == F.col("snap_ids")) & (F.col("api_n") == F.col("snap_n")), F.lit(False))
    meta = distinct_nodes(api).select("tree_id", F.col("id").alias("parent_id"), F.col("title").alias("meta_title"), F.col("parent_id").alias("above"))
    old = snapshot.groupBy("tree_id", F.col("id").alias("parent_id")).agg(F.max_by("title", F.coalesce("pos", F.lit(-1))).alias("snap_title"), F.count("*").alias("known"))
    rows = sets.withColumn("same", fast).join(meta, ["tree_id", "parent_id"]).join(old, ["tree_id", "parent_id"], "left")
    rows = rows.withColumn("fast", F.col("same") & F.col("known").isNotNull() & F.col("above").isNotNull())
    slow = F.coalesce(T.filled(F.col("meta_title")), F.concat(F.lit("page_"), F.col("parent_id")))
    return rows.select("tree_id", "parent_id", F.col("api_n").alias("n_children"), "fast", F.when(F.col("fast"), F.col("snap_title")).otherwise(slow).alias("title"))


def choose_root(checkpoint_id: str | None, resume_id: str | None, given_id: str | None) -> str:
    """The id a crawl starts from: checkpoint, then resume, then the given one; a checkpoint and a resume id together are an error."""
    if checkpoint_id and resume_id:
        raise ValueError("a checkpoint and a resume id exclude each other")
    for choice in (checkpoint_id, resume_id, given_id):
        if choice:
            return choice
    raise ValueError("no root id")


def unique_names(expanded: DataFrame, segment: Column) -> DataFrame:
    """Adds ``folder``: the segment, made unique among siblings: the first in order keeps it, later ones get ``_<id>``.

    A generated name counts as used for later siblings but isn't checked itself. Siblings aren't gathered: a node is a later one if its order is beyond the least
    of its (parent, segment); names that collide with generated ones are found by joins until none is left.
    """
    at = F.struct(F.col("pos"), F.col("id"))
    rows = expanded.withColumn("__seg", segment).withColumn("__at", at).withColumn("__par", F.coalesce("parent_id", F.lit("")))
    first = rows.groupBy("tree_id", "__par", "__seg").agg(F.min("__at").alias("__first"))
    rows = cut(rows.join(first, ["tree_id", "__par", "__seg"]).withColumn("__made", F.col("__at") > F.col("__first")).drop("__first"))
    made_name = F.concat("__seg", F.lit("_"), "id")
    fresh = rows.where("__made")
    while True:
        taken = fresh.groupBy("tree_id", "__par", made_name.alias("__seg")).agg(F.min("__at").alias("__since"))
        hit = rows.where(~F.col("__made")).join(taken, ["tree_id", "__par", "__seg"]).where(F.col("__at") > F.col("__since")).select("tree_id", F.col("id"), F.lit(True).alias("__hit"))
        hit = cut(hit)
        if hit.isEmpty():
            break
        rows = cut(rows.join(hit, ["tree_id", "id"], "left").withColumn("__made", F.col("__made") | F.coalesce("__hit", F.lit(False))).drop("__hit"))
        fresh = rows.join(hit, ["tree_id", "id"], "left_semi")
    return rows.withColumn("folder", F.when(F.col("__made"), made_name).otherwise(F.col("__seg"))).drop("__seg", "__at", "__par", "__made")


def paths(named: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Adds ``rel_parts`` and ``rel_path`` from the root's folder down; folders of ``failed`` (tree_id, id) get the failure suffix, which their descendants' paths show.

    An existing folder is never deleted.
    """
    rows = named
    folder = F.col("folder")
    if failed is not None:
        bad = failed.select("tree_id", "id", F.lit(True).alias("__bad")).distinct()
        rows = rows.join(bad, ["tree_id", "id"], "left")
        folder = F.when(F.col("__bad"), F.concat("folder", F.lit(FAILED_SUFFIX))).otherwise(F.col("folder"))
    rows = rows.withColumn("__name", folder).drop("__bad")
    steps = rows.select("tree_id", "id", F.posexplode("ids").alias("__k", "__step"))
    names = rows.select(F.col("tree_id").alias("t"), F.col("id").alias("__step"), F.col("__name").alias("n"))
    parts = steps.join(names, (F.col("tree_id") == F.col("t")) & (steps["__step"] == names["__step"]))
    parts = parts.groupBy("tree_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "n"))), lambda s: s["n"]).alias("rel_parts"))
    return rows.drop("__name").join(parts, ["tree_id", "id"]).withColumn("rel_path", F.array_join("rel_parts", "/"))


def resume_plan(ordered: DataFrame, targets: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds ``action``: ``skip_before`` (up to and including the tree's target in pre-order), ``skip_existing`` (its file exists and isn't empty), ``export``.

    ``targets``: tree_id, target_id (of an interrupted run); a target that isn't in the tree has no effect. ``existing``: tree_id, id, size.
    """
    last = ordered.join(bounded_broadcast(targets.select(F.col("tree_id").alias("t"), "target_id")), (F.col("tree_id") == F.col("t")) & (F.col("id") == F.col("target_id")))
    last = last.groupBy(F.col("tree_id").alias("t")).agg(F.min("preorder").alias("__upto"))
    there = existing.where(F.col("size") > 0).select("tree_id", "id", F.lit(True).alias("__there")).distinct()
    rows = ordered.join(bounded_broadcast(last), F.col("tree_id") == F.col("t"), "left").drop("t").join(there, ["tree_id", "id"], "left")
    action = F.when(F.col("preorder") <= F.col("__upto"), "skip_before").when(F.col("__there"), "skip_existing").otherwise("export")
    return rows.withColumn("action", action).drop("__upto", "__there")


def interrupted_target(resume: bool, status: str, state_tree: Column, tree: Column, page_id: Column) -> Column:
    """The page a run resumes behind, or the empty text: only when resuming an interrupted run of the same tree."""
    ok = F.lit(resume and status == "interrupted") & state_tree.eqNullSafe(tree)
    return F.when(ok, T.strip(F.coalesce(page_id, F.lit("")))).otherwise("")


def export_roots(trees: DataFrame, base: str) -> DataFrame:
    """Adds ``out_root``: the base for a single tree, else a folder per tree below it."""
    many = trees.select("tree_id").distinct().limit(2).count() > 1
    return trees.withColumn("out_root", F.concat(F.lit(base + "/"), "tree_id") if many else F.lit(base))


def drawing(expanded: DataFrame) -> DataFrame:
    """Adds ``line``: the node in a console drawing with ``├── └── │``; order lines by (tree_id, ord).

    Whether an ancestor is its parent's last child is looked up from the siblings' greatest order.
    """
    last = expanded.where("depth > 0").groupBy("tree_id", "parent_id").agg(F.max(F.struct("pos", "id")).alias("m"))
    ends = last.select(F.col("tree_id").alias("t"), F.col("m.id").alias("last_id"), F.lit(True).alias("is_last"))
    steps = expanded.select("tree_id", "id", F.posexplode("ids").alias("k", "step"))
    flags = steps.join(ends, (F.col("tree_id") == F.col("t")) & (F.col("step") == F.col("last_id")), "left")
    is_end = F.coalesce("is_last", F.col("k") == 0)
    flags = flags.groupBy("tree_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", is_end.alias("e")))), lambda s: s["e"]).alias("ends"))
    rows = expanded.join(flags, ["tree_id", "id"])
    stem = F.array_join(F.transform(F.slice("ends", F.lit(1), F.size("ends") - 1), lambda e: F.when(e, "    ").otherwise("│   ")), "")
    own = F.when(F.element_at("ends", -1), "└── ").otherwise("├── ")
    return rows.withColumn("line", F.concat(stem, own, F.coalesce("title", F.lit("")), F.lit("  (id="), F.col("id"), F.lit(")"))).drop("ends")


def completed_trees(statuses: DataFrame) -> DataFrame:
    """(tree_id): trees of which no page failed."""
    return statuses.groupBy("tree_id").agg(F.count_if(F.col("status") == "fail").alias("f")).where("f = 0").select("tree_id")


def node_counts(expanded: DataFrame) -> DataFrame:
    """(tree_id, visited, max_depth, leaves): the progress counter's final state."""
    kids = expanded.where(F.col("depth") > 0).select("tree_id", F.col("parent_id").alias("id")).distinct().withColumn("p", F.lit(1))
    rows = expanded.join(kids, ["tree_id", "id"], "left")
    return rows.groupBy("tree_id").agg(F.count("*").alias("visited"), F.max("depth").alias("max_depth"), F.count_if(F.col("p").isNull()).alias("leaves"))
