"""Mixing sources to target weights by Poisson replication.

Each row is repeated as often as a Poisson distribution says whose mean is its source's target
repetition rate; the draw inverts the distribution at a uniform number hashed from the seed and the
row's id. Nothing but the counts per source crosses a shuffle before the copies are made, and the
copies are dealt out once, in the order of a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import packed, shuffle_partitions, stored

# exp(-mean) must not underflow: a larger mean is the sum of several draws with this mean at most.
MEAN_PER_DRAW = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(2.0**52)


def poisson_cdf(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, ... as an array, until it is 1 within rounding."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    begin = F.exp(-mean)

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    steps = F.transform(F.sequence(F.lit(1), last), lambda k: k.cast("double"))
    return F.aggregate(steps, F.struct(begin.alias("p"), F.array(begin).alias("c")), add)["c"]


def source_rates(
    docs: DataFrame,
    source_col: str = "source",
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    total: int | None = None,
) -> DataFrame:
    """(source, n_rows, rate): how often a row of each source is to be repeated on average.

    ``weights`` (source, weight) gives the target shares, scaled to 1 over the sources that have
    rows; a source it does not list, or lists with NULL or less than 0, gets none. Without it a
    source's share is in proportion to its rows to the power ``exponent``. ``total`` is the number
    of rows aimed at, by default as many as there are. NULL is a source of its own.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        shares = counts.withColumn("_w", F.pow(F.col("n_rows").cast("double"), F.lit(float(exponent))))
    else:
        wanted = weights.groupBy(F.col("source").alias("_source")).agg(F.max("weight").cast("double").alias("_w"))
        shares = counts.join(wanted, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
        shares = shares.withColumn("_w", F.greatest(F.coalesce("_w", F.lit(0.0)), F.lit(0.0)))
    # One row per source, written so that Spark knows its size and broadcasts it only if small.
    shares = stored(shares, "source-shares")
    sums = shares.agg(F.sum("_w").alias("_ws"), F.sum("n_rows").alias("_rows")).first()
    aim = float(total if total is not None else sums["_rows"] or 0)
    scale = aim / sums["_ws"] if sums["_ws"] else 0.0
    return shares.select("source", "n_rows", (F.lit(scale) * F.col("_w") / F.col("n_rows")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    total: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """Rows repeated to the target weights, in an order shuffled over all partitions.

    Columns: ``row`` (the whole input row as a struct, whatever its names), copy (from 1), copies,
    shuffle_key (MD5 of seed, id and copy). Partition i holds the keys of the i-th equal share of all
    keys and is sorted, so the files in order are in random order. Rows that share an id are drawn
    alike; a NULL id is drawn as the text 'null'. A rate of 0 gives no copies; no rows give no rows.
    Texts are not looked at.
    """
    parts = F.greatest(F.ceil(F.col("rate") / MEAN_PER_DRAW), F.lit(1)).cast("int")
    rates = source_rates(docs, source_col, weights, exponent, total).select(
        F.col("source").alias("_source"), parts.alias("_draws"), poisson_cdf(F.col("rate") / parts).alias("_cdf")
    )
    rows = packed(docs, "row").withColumn(
        "_name", F.coalesce(F.col(f"row.{id_col}").cast("string"), F.lit("null"))
    )
    rows = rows.join(rates, F.col(f"row.{source_col}").eqNullSafe(F.col("_source")))
    start = F.lit(str(seed))

    def draw(so_far: Column, j: Column) -> Column:
        u = uniform(start, F.lit("draw"), j.cast("string"), F.col("_name"))
        return so_far + F.size(F.filter("_cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(0), F.col("_draws") - 1), F.lit(0), draw)
    made = rows.withColumn("copies", copies).filter("copies > 0")
    made = made.select("row", "_name", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    key = F.md5(F.concat_ws(":", start, F.lit("order"), F.col("copy").cast("string"), F.col("_name")))
    made = made.withColumn("shuffle_key", key)
    n = shuffle_partitions(docs.sparkSession)
    # The key is uniform already: equal shares of its range need no sampling.
    share = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("bigint") * n / F.lit(2.0**32)).cast("int")
    return (
        made.select("row", "copy", "copies", "shuffle_key")
        .repartitionById(n, share)
        .sortWithinPartitions("shuffle_key")
    )
