"""Running sums per key in two levels, so that no key has to fit one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.operators.lookup import look_up
from fleetwarden.session import stored

# monotonically_increasing_id() counts the rows of a partition in its lower bits.
_ROW_BITS = 33


def ranged(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows range-partitioned and sorted by ``columns``, and stored, with _part and _row.

    A key of any size is spread over as many partitions as it fills; they follow its order.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    held = stored(spread.withColumn("_id", F.monotonically_increasing_id()), "ranged")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return held.withColumns({"_part": F.shiftright("_id", _ROW_BITS), "_row": row}).drop("_id")


def sums_before(held: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Rows of :func:`ranged`, or some of them, with ``out``: the sum of ``value`` over the rows of ``key`` before.

    What a key has in each partition is one row of a small table, whose running sum is the offset of
    that partition; to it comes the running sum within the partition. No task holds more of a key
    than one partition of the range. ``key`` must not be NULL.
    """
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy(key, "_part").agg(F.sum(value).alias("_sum"))
    offsets = sums.select(key, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(key, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(within), F.lit(0))
    found = look_up(held, offsets, [key, "_part"])
    return found.withColumn(out, F.coalesce(F.col("_offset"), F.lit(0)) + here).drop("_offset")
