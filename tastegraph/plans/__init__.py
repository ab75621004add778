"""Queries on the test tables and the SQL each one is checked against."""

from __future__ import annotations

import importlib

_FAMILIES = ["shaping", "affinity", "rules", "graph", "scoring", "text", "evaluation"]


def _modules():
    return [importlib.import_module(f"tastegraph.plans.{f}_queries") for f in _FAMILIES]


def all_queries() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
