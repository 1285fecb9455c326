"""Side-by-side run of a Spark query and its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, build, sql, sf_dir):
    """(row count, list of differences)."""
    got = build(spark, sf_dir)
    mine = got.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(got.columns):
        return len(mine), [f"columns {sorted(got.columns)} against {sorted(names)}"]
    a, b = rows_of(got.columns, mine), rows_of(names, theirs)
    faults = []
    if a != b:
        only_a, only_b = list((a - b).items()), list((b - a).items())
        faults.append(f"rows {len(mine)} against {len(theirs)}; only ours {len(only_a)} {only_a[:2]}; "
                      f"only theirs {len(only_b)} {only_b[:2]}")
    return len(mine), faults
