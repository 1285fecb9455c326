"""Joins to a table that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_all(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def look_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` joined (left or left_semi) to a table unique by ``keys``; NULL keys match nothing.

    The comparison is null-safe on purpose. A table that was just grouped by the same keys would be
    joined where it lies, and adaptive execution splits a very frequent key only between two
    shuffles of the join's own; the null-safe form always has these. A table whose measured size
    allows it is broadcast either way.
    """
    table = table.filter(has_all(keys))
    found = table.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(found, same, how).drop(*[f"_key_{k}" for k in keys])
