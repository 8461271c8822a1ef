"""Run registered queries next to their SQL text in DuckDB and compare the results."""

from __future__ import annotations

import math
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{directory}/{table}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows), [names[i] for i in order]


def compare(spark, con, directory: str, build, sql: str) -> tuple[bool, str]:
    """Whether both sides give the same columns and rows; else what differs first."""
    started = time.time()
    df = build(spark, directory)
    ours, our_names = _rows(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - started
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs, their_names = _rows(names, result.fetchall())
    note = f"{len(ours)} rows, {spent:.1f} s"
    if our_names != their_names:
        return False, f"columns {our_names} != {their_names}"
    if ours != theirs:
        left = [r for r in ours if r not in set(theirs)][:2]
        right = [r for r in theirs if r not in set(ours)][:2]
        return False, f"{len(ours)} rows != {len(theirs)} rows; only here {left}; only SQL {right}"
    return True, note
