"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import importlib

_MODULES = ["relational", "text", "sampling", "evaluation", "bayes", "regression", "timeseries", "learning", "streams", "files"]


def all_queries() -> dict:
    found = {}
    for name in _MODULES:
        found.update(importlib.import_module(f"sparkmine.plans.{name}").QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    found = {}
    for name in _MODULES:
        found.update(importlib.import_module(f"sparkmine.plans.{name}").ORACLE)
    return found
