"""Queries over the given tables, one or more for each operator."""

from __future__ import annotations

from importlib import import_module

from segue.plans.registry import QUERIES, Query

MODULES = ["basics", "lists", "features", "retrieval", "watch", "storage"]


def load_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"segue.plans.{module}")
    return QUERIES
