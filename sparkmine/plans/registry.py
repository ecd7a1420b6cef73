"""Decorator that registers a query and its SQL under the function's name."""

from __future__ import annotations

from collections.abc import Callable


def registrar(queries: dict, oracle: dict[str, str]) -> Callable:
    def query(sql: str | None = None) -> Callable:
        def add(fn: Callable) -> Callable:
            queries[fn.__name__] = fn
            if sql is not None:
                oracle[fn.__name__] = sql
            return fn

        return add

    return query
