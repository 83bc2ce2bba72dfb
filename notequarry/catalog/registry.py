"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from notequarry.catalog.sql import statement

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_TYPES = {"i": "INTEGER", "l": "BIGINT", "s": "VARCHAR"}


def pick(spec: str, source: str, rest: str = "") -> str:
    """``SELECT`` of named columns, ``name:i`` cast to int, ``name:l`` to bigint."""
    columns = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        columns.append(f'CAST("{name}" AS {_TYPES[kind]}) AS "{name}"' if kind else f'"{name}"')
    return f"SELECT {', '.join(columns)} FROM {source} {rest}"


def query(sql: str | None = None, extra: dict[str, str] | None = None, name: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = statement(sql, extra)
        return function

    return register
