"""Registration of queries next to the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, Callable]:
    """A fresh name -> (query, SQL or None) table and the decorator that fills it."""
    entries: dict = {}

    def query(name: str, sql: str | None = None) -> Callable:
        def add(fn: Callable) -> Callable:
            entries[name] = (fn, sql)
            return fn

        return add

    return entries, query
