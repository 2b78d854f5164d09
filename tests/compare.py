"""Compare a registered query with its oracle as strictly as values allow."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and v != v:
        return None
    return v


def rows_of(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in records)


# Operators that would make a query grow faster than its input or leave the JVM row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "collect_list")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def difference(spark, con, function, sql: str, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    df = function(spark, sf_dir)
    got = df.collect()
    bad = [name for name in UNWANTED if name in plan_of(df)]
    if bad:
        return f"plan has {bad}"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if not got:
        return "no rows"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"rows {len(got)} / {len(want)}; only spark {extra}; only sql {missing}"
    types = {type(v) for row in a for v in row} | {type(v) for row in b for v in row}
    odd = types - {int, str, float, bool, type(None)}
    if odd:
        return f"types {odd}"
    kinds = [
        [{type(v) for v in column if v is not None} for column in zip(*rows, strict=True)]
        for rows in (a, b)
    ]
    return None if kinds[0] == kinds[1] else f"kinds {kinds}"
