"""Named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict[str, str], Callable]:
    """``QUERIES``, ``SQL`` and the decorator that fills them."""
    queries: dict = {}
    sql: dict[str, str] = {}

    def query(name: str, text: str | None = None):
        def add(f):
            queries[name] = f
            if text is not None:
                sql[name] = text
            return f

        return add

    return queries, sql, query
