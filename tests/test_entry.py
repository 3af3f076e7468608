"""The driver's contract on the smallest tables, and that the core doesn't need the optional subpackage."""

import ast
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from leafmill.plans import registry

DATA = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parents[1]
SLOW = {"clean_totals"}


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def test_core_never_imports_the_subpackage():
    for f in (ROOT / "leafmill").rglob("*.py"):
        if "llm" in f.relative_to(ROOT / "leafmill").parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), f


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not DATA.exists(), reason="no test data here")
@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SLOW))
def test_core_query_matches_its_oracle(spark, name):
    df = entry.queries()[name](spark, str(DATA))
    rows, columns = df.collect(), sorted(df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    found = con.sql(sql)
    want = [dict(zip(found.columns, r)) for r in found.fetchall()]
    key = lambda r: repr(r)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=key) == sorted((tuple(plain(r[c]) for c in columns) for r in want), key=key)
