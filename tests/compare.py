"""Run a registered query and its SQL statement on the same tables and compare names, types and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT",
    "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sort_key(row: tuple) -> tuple:
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def _cells(rows: list, order: list[int]) -> list[tuple]:
    return sorted((tuple(row[i] for i in order) for row in rows), key=_sort_key)


def compare(frame, sql: str, connection) -> list[str]:
    """A list of differences; empty when both sides agree exactly (doubles to 1 part in 10^9)."""
    cursor = connection.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    names = sorted(frame.columns)
    if names != sorted(expected_types):
        return [f"columns {names} != {sorted(expected_types)}"]
    problems = []
    for field in frame.schema.fields:
        ours = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if ours != expected_types[field.name]:
            problems.append(f"type of {field.name}: {ours} != {expected_types[field.name]}")
    listed = list(expected_types)
    actual = _cells([tuple(r) for r in frame.collect()], [frame.columns.index(n) for n in names])
    expected = _cells(expected_rows, [listed.index(n) for n in names])
    if len(actual) != len(expected):
        return [*problems, f"rows {len(actual)} != {len(expected)}"]
    loose = 0
    for a, b in zip(actual, expected):
        for x, y, n in zip(a, b, names):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12):
                loose += 1
                continue
            return [*problems, f"{n}: {x!r} != {y!r} in {a} / {b}"]
    if loose:
        problems.append(f"{loose} doubles equal only approximately")
    return problems
