"""Run registered queries next to their DuckDB statements."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(value) -> str:
    return type(value).__name__


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark frame and a statement, or nothing."""
    names = sorted(df.columns)
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} against {sorted(theirs_names)}"
    order = [theirs_names.index(n) for n in names]
    theirs = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    ours = [tuple(plain(row[n]) for n in names) for row in df.collect()]
    for i, n in enumerate(names):
        kinds = [{kind(r[i]) for r in rows if r[i] is not None} for rows in (ours, theirs)]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1]:
            return f"type of {n}: {kinds}"
    a, b = Counter(ours), Counter(theirs)
    if a != b:
        return (
            f"{len(ours)} rows against {len(theirs)}; names {names}; only ours "
            f"{list((a - b).items())[:2]}; only theirs {list((b - a).items())[:2]}"
        )
    return None
