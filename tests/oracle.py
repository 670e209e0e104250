"""Compare a registered query with its SQL twin, run by DuckDB on the same files."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(record[i]) for i in order) for record in records)


def compare(df, con, sql) -> str | None:
    """None when names, row count and values agree, else a short account of the difference."""
    names, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    other_names, other = rows_of([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} != {other_names}"
    if mine != other:
        extra = [r for r in mine if r not in set(other)][:3]
        missing = [r for r in other if r not in set(mine)][:3]
        return f"{len(mine)} rows vs {len(other)}; ours only {extra}; theirs only {missing}"
    return None
