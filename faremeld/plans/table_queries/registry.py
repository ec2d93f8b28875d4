"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def all_queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)
