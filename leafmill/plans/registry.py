"""All queries of the core with their oracle SQL."""

from __future__ import annotations

from leafmill.plans import file_queries, page_queries, scalars, training, tree_queries

MODULES = [training, scalars, page_queries, tree_queries, file_queries]
FLAGSHIP = training.p5_found


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in getattr(module, "ORACLES", {}).items()}
