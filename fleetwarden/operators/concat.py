"""Ordered text concatenation per key, in parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.functions.text import sql_string
from fleetwarden.operators.lookup import look_up

# Largest cell: what a key holds beyond it goes to further rows.
MAX_CELL_BYTES = 16 * 1024 * 1024


def ordered_concat(
    rows: DataFrame,
    keys: Sequence[str],
    text: Column,
    order: Sequence[Column],
    sep: str = "",
    out: str = "definition",
    max_cell_bytes: int = MAX_CELL_BYTES,
    last: Sequence[str] = (),
    head: Column | None = None,
) -> DataFrame:
    """Texts of each key joined by ``sep`` in ``order``: (keys, part_no, out).

    A key of at most half a cell's bytes is one part, number 0. The rows of a longer key are spread
    over as many range partitions as they fill (:func:`_parts`), and a row goes to the part that half a
    cell's worth of bytes before it in its partition say; so a cell holds ``max_cell_bytes`` at most unless one
    row alone has more than half of that. Parts, joined by ``sep`` in the order of their numbers, are the whole
    text; gaps in the numbers are allowed, and a long key's parts may be cut and numbered otherwise in another
    run. Columns named in ``last`` come from the last row of the part.
    ``head``, made of the keys, goes once in front of the texts. NULL keys are keys like all others.
    """
    keys = list(keys)
    # Order columns of their own: listagg sorts by a struct several times slower.
    places = [f"_order{i}" for i in range(len(order))]
    order_columns = [c.alias(name) for c, name in zip(order, places)]
    rows = rows.select(*keys, text.alias("_text"), *order_columns, *last)
    rows = rows.withColumn("_bytes", F.coalesce(F.octet_length("_text") + len(sep.encode()), F.lit(0)))
    half = max(1, max_cell_bytes // 2)
    # One struct, never NULL, so that NULL keys are keys like all others.
    rows = rows.withColumn("_key", F.struct(*keys))
    place = F.struct(*places, "_text")
    long_ = rows.groupBy("_key").agg(F.sum("_bytes").alias("_all"), F.min(place).alias("_least"))
    long_ = long_.filter(F.col("_all") > half).select("_key", "_least")
    short = look_up(rows, long_.select("_key"), ["_key"], "left_anti")
    short = short.withColumns({"part_no": F.lit(0).cast("bigint"), "_begins": F.lit(True)})
    more = _parts(look_up(rows, long_, ["_key"]).filter("_least is not null"), places, half)
    more = more.withColumn("_begins", place == F.col("_least")).drop("_least")
    both = short.unionByName(more)
    texts = F.expr(f"listagg(_text, {sql_string(sep)}) within group (order by {', '.join(places)})")
    cell = texts if head is None else F.when(F.bool_or("_begins"), F.concat_ws(sep, head, texts)).otherwise(texts)
    others = [F.max_by(c, F.struct(*places)).alias(c) for c in last]
    return both.groupBy(*keys, "part_no").agg(cell.alias(out), *others).select(*keys, "part_no", out, *last)


def _parts(rows: DataFrame, places: Sequence[str], half: int) -> DataFrame:
    """``part_no`` of each row of long keys: its range partition, and the cell within it.

    The partitions follow the order of a key, so their numbers and the running sum of bytes within
    (key, partition) say all; no task holds more of a key than one partition of the range.
    """
    columns = ["_key", *places, "_text"]
    held = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    # Counts partitions in its upper 31 bits, and the rows of a partition below.
    held = held.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    within = Window.partitionBy("_key", "_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    here = F.floor(F.coalesce(F.sum("_bytes").over(within), F.lit(0)) / F.lit(half)).cast("bigint")
    part = F.col("_part") * (1 << 31) + here
    return held.withColumn("part_no", part).drop("_part", "_id")
