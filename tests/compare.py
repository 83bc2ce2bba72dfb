"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def kinds(arrow_schema) -> dict[str, str]:
    names = {"large_string": "string", "string_view": "string"}
    return {f.name: names.get(str(f.type), str(f.type)) for f in arrow_schema}


def rows(table) -> Counter:
    order = sorted(table.column_names)
    columns = []
    for name in order:
        values = table.column(name).to_pylist()
        simple = str(table.schema.field(name).type) in ("int32", "int64", "string", "large_string", "bool")
        columns.append(values if simple else [plain(v) for v in values])
    return Counter(zip(*columns))


def compare(frame, con, sql: str) -> list[str]:
    """Differences between a Spark result and its SQL, empty when they agree."""
    ours = frame.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    problems = []
    if kinds(ours.schema) != kinds(theirs.schema):
        a, b = kinds(ours.schema), kinds(theirs.schema)
        problems.append(f"schema {[(k, a.get(k), b.get(k)) for k in sorted({*a, *b}) if a.get(k) != b.get(k)]}")
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return problems
    a, b = rows(ours), rows(theirs)
    if a != b:
        problems.append(
            f"rows {ours.num_rows} vs {theirs.num_rows}; only ours {list((a - b).items())[:3]}; "
            f"only theirs {list((b - a).items())[:3]}"
        )
    if not problems and ours.num_rows == 0:
        problems.append("no rows")
    return problems
