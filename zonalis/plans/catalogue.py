"""All registered queries."""

import importlib

from zonalis.plans.registry import REGISTRY, Query

MODULES = (
    "scalar_queries", "table_queries", "join_queries", "io_queries", "integrate_queries",
    "quality_queries", "stats_queries",
)


def all_queries() -> dict[str, Query]:
    for m in MODULES:
        importlib.import_module(f"zonalis.plans.{m}")
    return dict(REGISTRY)
