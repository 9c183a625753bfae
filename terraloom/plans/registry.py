"""A decorator that files a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    queries: dict = {}
    oracles: dict = {}

    def query(sql: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, query
