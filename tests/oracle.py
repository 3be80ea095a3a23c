"""Runs a query on Spark and its SQL in DuckDB and compares the rows.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "array<double>": "DOUBLE[]",
}


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    return value


def _rows(rows):
    return sorted((tuple(_cell(v) for v in row) for row in rows), key=repr)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else the first difference."""
    names = sorted(frame.columns)
    result = connection.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    if sorted(described) != names:
        return f"columns {names} against {sorted(described)}"
    kinds = dict(frame.dtypes)
    for name in names:
        if _KINDS.get(kinds[name]) != described[name]:
            return f"type of {name}: {kinds[name]} against {described[name]}"
    place = [list(described).index(n) for n in names]
    expected = _rows(tuple(row[i] for i in place) for row in result.fetchall())
    actual = _rows(tuple(r) for r in frame.select(*[f"`{n}`" for n in names]).collect())
    if len(expected) != len(actual):
        return f"{len(actual)} rows against {len(expected)}"
    wrong = [(a, b) for a, b in zip(actual, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, first {names}: {wrong[0][0]} against {wrong[0][1]}"
    return None if actual else "no rows"


def main() -> int:
    from tests.session import local_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = sys.argv[2:] or list(queries)
    bad = 0
    for name in chosen:
        began = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(frame, connection, oracles[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - began:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
