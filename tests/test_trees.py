import random

from pyspark.sql import functions as F

from leafmill.operators import trees as X
from leafmill.sources.tree_json import flatten, nodes_of, tree_documents

SCHEMA = "tree_id string, id string, parent_id string, pos int, title string, node_type string, slug string, kind string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA)


def roots(spark, *pairs):
    return spark.createDataFrame(list(pairs), "tree_id string, root_id string")


def test_random_tree_matches_a_walk(spark):
    r = random.Random(3)
    kids, rows = {}, [("t", "0", None, 0, "root", "page", None)]
    for i in range(1, 200):
        p = r.randrange(i)
        kids.setdefault(p, []).append(i)
        rows.append(("t", str(i), str(p), r.randrange(3), f"n{i % 5}", None, None))
    pos = {int(x[1]): (x[3], x[1]) for x in rows}
    order = []

    def walk(n):
        order.append(n)
        for c in sorted(kids.get(n, []), key=lambda c: pos[c]):
            walk(c)

    walk(0)
    got = X.preorder(X.expand(table(spark, rows + rows[:5]), roots(spark, ("t", "0")))).orderBy("preorder").collect()
    assert [int(x.id) for x in got] == order and [x.preorder for x in got] == list(range(1, 201))


def test_deep_chain_cycle_and_orphans(spark):
    chain = [("t", str(i), str(i - 1) if i else None, 0, f"n{i}", "page", None) for i in range(130)]
    bad = [("t", "x", "y", 0, "a", "page", None), ("t", "y", "x", 0, "b", "page", None), ("t", "o", "", 0, "c", None, None), ("t", "m", "missing", 0, None, None, None), (None, "z", None, 0, None, None, None)]
    out = X.expand(table(spark, chain + bad), roots(spark, ("t", "0")))
    assert out.count() == 130 and out.agg(F.max("depth")).first()[0] == 129
    assert X.expand(table(spark, chain), roots(spark, ("t", "0")), 3).count() == 4
    assert X.expand(table(spark, chain).where("id < ''"), roots(spark, ("t", "0"))).count() == 0


def test_sibling_names_with_generated_collision(spark):
    rows = [("t", "r", None, 0, "r", "page", None), ("t", "1", "r", 0, "X", "page", None), ("t", "5", "r", 1, "X", "page", None), ("t", "7", "r", 2, "X_5", "page", None), ("t", "8", "r", 3, "X_5_7", "page", None), ("t", "9", "r", 4, "Y", "page", None)]
    out = X.unique_names(X.expand(table(spark, rows), roots(spark, ("t", "r"))), F.col("title"))
    assert {x.id: x.folder for x in out.collect()} == {"r": "r", "1": "X", "5": "X_5", "7": "X_5_7", "8": "X_5_7_8", "9": "Y"}


def test_failed_folder_shows_in_descendants(spark):
    rows = [("t", "r", None, 0, "r", "page", None), ("t", "1", "r", 0, "a", "page", None), ("t", "2", "1", 0, "b", "page", None)]
    named = X.unique_names(X.expand(table(spark, rows), roots(spark, ("t", "r"))), F.col("title"))
    failed = spark.createDataFrame([("t", "1")], "tree_id string, id string")
    assert {x.id: x.rel_path for x in X.paths(named, failed).collect()}["2"] == "r/a_空/b"


def test_drawing_and_json_round_trip(spark):
    rows = [("t", "r", None, 0, "R", "page", "s"), ("t", "1", "r", 0, "A", "page", None), ("t", "2", "1", 0, "B", "page", None), ("t", "3", "r", 1, "C", "page", None)]
    tree = X.expand(table(spark, rows), roots(spark, ("t", "r")))
    assert [x.line for x in X.drawing(tree).orderBy("ord").collect()] == ["└── R  (id=r)", "    ├── A  (id=1)", "    │   └── B  (id=2)", "    └── C  (id=3)"]
    again = nodes_of(tree_documents(tree), "tree_id", "json")
    assert sorted((x.id, x.parent_id, x.pos, x.title) for x in again.collect()) == [("1", "r", 0, "A"), ("2", "1", 0, "B"), ("3", "r", 1, "C"), ("r", None, 0, "R")]
    assert flatten("t", None) == flatten("t", "{bad") == flatten("t", "{}") == []


def test_reconcile_states(spark):
    api = [("t", "r", None, 0, "R", "page", None), ("t", "1", "r", 0, "new title", "page", None), ("t", "2", "r", 1, "two", "page", None)]
    old = [("t", "r", None, 0, "R", "page", None), ("t", "1", "r", 5, "older", "page", None), ("t", "1", "r", 6, "old title", "page", None), ("t", "9", "r", 1, "gone", "page", None)]
    got = {x.id: (x.state, x.title) for x in X.reconcile(table(spark, api), table(spark, old)).collect()}
    assert got == {"1": ("kept", "old title"), "2": ("new", "two"), "9": ("dropped", "gone")}


def test_root_choice():
    import pytest

    assert X.choose_root("a", None, "c") == "a" and X.choose_root(None, "b", "c") == "b" and X.choose_root(None, None, "c") == "c"
    with pytest.raises(ValueError):
        X.choose_root("a", "b", None)
