"""Chunked table checksums, and trees of them: primary against replica."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.session import stored

# Children of a node of a hash tree, and nodes that a walk down the tree follows at once.
FANOUT = 64
FRONTIER = 64
_WHOLE = {"byte": 8, "short": 16, "integer": 32, "long": 64}  # bits of whole-number keys

# Fixed value: schemas that are never compared.
IGNORED_DATABASES = ("mysql",)


def row_digest(columns: Sequence[str], method: str = "xxhash64") -> Column:
    """64-bit (``xxhash64``) or 60-bit (``md5``) digest of a row.

    Every value goes in with its length in front, and NULL as a mark of its own, so that different
    rows never give the same text.
    """
    def part(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    text = F.concat(*[part(c) for c in columns])
    if method == "xxhash64":
        return F.xxhash64(text)
    if method != "md5":
        raise ValueError(f"unknown digest {method!r}")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def chunk_of(table: DataFrame, key: str, chunk_size: int) -> Column:
    """Chunk of a row: ``chunk_size`` consecutive whole-number keys, rounded down.

    Keys of another type are spread over ``chunk_size`` chunks by a digest. NULL keys are a chunk.
    """
    column = F.col(key)
    if table.schema[key].dataType.typeName() not in _WHOLE:
        return F.when(column.isNotNull(), F.pmod(F.xxhash64(column.cast("string")), F.lit(chunk_size))).cast("bigint")
    return F.call_function("div", column - F.pmod(column, F.lit(chunk_size)), F.lit(chunk_size))


def _combined(digest: Column) -> list[Column]:
    """Count, xor and a sum of the low bits: equal rows cancel in the xor, but not in the sum."""
    return [
        F.count("*").alias("row_count"),
        F.bit_xor(digest).alias("digest"),
        F.sum(F.pmod(digest, F.lit(1 << 31))).alias("digest_sum"),
    ]


def table_checksum(
    table: DataFrame,
    key: str,
    columns: Sequence[str],
    chunk_size: int = 1000,
    method: str = "xxhash64",
) -> DataFrame:
    """Rows and combined digest per chunk of ``chunk_size`` consecutive keys.

    Count, xor and sum are reduced map-side: what is shuffled is one row per chunk and task,
    whatever the share of rows in one chunk.
    """
    return table.groupBy(chunk_of(table, key, chunk_size).alias("chunk")).agg(
        *_combined(row_digest([key, *columns], method))
    )


def _differing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full join of two combined tables by ``key`` (NULL included), without the equal rows."""
    names = ["row_count", "digest", "digest_sum"]
    p = left.withColumnsRenamed({key: "_pk"} | {n: f"p_{n}" for n in names})
    r = right.withColumnsRenamed({key: "_rk"} | {n: f"r_{n}" for n in names})
    both = p.join(r, F.col("_pk").eqNullSafe(F.col("_rk")), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"p_{n}").eqNullSafe(F.col(f"r_{n}")) for n in names])
    return both.filter(~same).withColumn(key, F.coalesce("_pk", "_rk")).drop("_pk", "_rk")


def checksum_diff(
    primary: DataFrame,
    replica: DataFrame,
    key: str,
    columns: Sequence[str],
    chunk_size: int = 1000,
    method: str = "xxhash64",
) -> DataFrame:
    """Chunks whose row count or digest differ between primary and replica."""
    left = table_checksum(primary, key, columns, chunk_size, method)
    right = table_checksum(replica, key, columns, chunk_size, method)
    return _differing(left, right, "chunk").select(
        "chunk",
        F.coalesce("p_row_count", F.lit(0)).alias("primary_rows"),
        F.coalesce("r_row_count", F.lit(0)).alias("replica_rows"),
    )


def hash_tree(leaves: DataFrame, height: int) -> DataFrame:
    """(level, node, row_count, digest, digest_sum): chunks as level 0, and digests of digests above.

    A node of level n + 1 stands for the FANOUT nodes of level n that follow each other, whatever their
    number in the table. The chunk of NULL keys is a node of its own on every level.
    """
    level = leaves.withColumnRenamed("chunk", "node")
    levels = [level.withColumn("level", F.lit(0))]
    for n in range(1, height + 1):
        own = F.xxhash64("node", "row_count", "digest", "digest_sum")
        level = level.groupBy(F.call_function("div", F.col("node") - F.pmod("node", F.lit(FANOUT)), F.lit(FANOUT)).alias("node")).agg(
            F.sum("row_count").alias("row_count"),
            F.bit_xor(own).alias("digest"),
            F.sum(F.pmod(own, F.lit(1 << 31))).alias("digest_sum"),
        )
        levels.append(level.withColumn("level", F.lit(n)))
    return reduce(DataFrame.unionByName, levels)


def tree_height(*leaves: DataFrame) -> int:
    """Levels above the chunks until the nodes of all tables fit one walk."""
    ends = reduce(DataFrame.unionByName, [t.select("chunk") for t in leaves]).agg(F.min("chunk"), F.max("chunk")).first()
    span, height = (ends[1] - ends[0] + 1 if ends[0] is not None else 1), 0
    while span > FRONTIER:
        span, height = -(-span // FANOUT) + 1, height + 1
    return height


def differing_nodes(primary: DataFrame, replica: DataFrame, height: int) -> tuple[int, list[int | None]]:
    """(level, nodes) that differ: both trees walked from the top, children of differing nodes only.

    The walk ends at the chunks, or a level before more than FRONTIER nodes differ; so what reaches the
    driver is bounded, and the nodes always cover every difference.
    """
    found: tuple[int, list[int | None]] = (height, [])
    parents: list[int | None] | None = None
    for level in range(height, -1, -1):
        sides = []
        for tree in (primary, replica):
            nodes = tree.filter(F.col("level") == level).drop("level")
            if parents is not None:
                low = [p * FANOUT for p in parents if p is not None]
                inside = [F.col("node").between(x, x + FANOUT - 1) for x in low]
                inside += [F.col("node").isNull()] if None in parents else []
                nodes = nodes.filter(reduce(lambda a, b: a | b, inside))
            sides.append(nodes)
        here = [r["node"] for r in _differing(*sides, "node").select("node").limit(FRONTIER + 1).collect()]
        if len(here) > FRONTIER:
            # At the top all nodes count; further down, the parents that are known to differ.
            return found if parents is not None else (level, [r[0] for r in sides[0].unionByName(sides[1]).select("node").distinct().collect()])
        found = (level, here)
        if not here:
            break
        parents = here
    return found


def _within(table: DataFrame, key: str, chunk_size: int, level: int, nodes: Sequence[int | None]) -> Column:
    """The rows of some nodes: ranges of whole-number keys, which reach the scan, or else chunks."""
    kind = table.schema[key].dataType.typeName()
    width = FANOUT**level
    ranges: list[list[int]] = []
    for node in sorted(n for n in nodes if n is not None):
        if ranges and ranges[-1][1] == node * width:
            ranges[-1][1] += width
        else:
            ranges.append([node * width, (node + 1) * width])
    found = F.col(key).isNull() if None in nodes else F.lit(False)
    for low, high in ranges:
        if kind in _WHOLE:
            most = 1 << (_WHOLE[kind] - 1)
            own = F.col(key).between(max(low * chunk_size, -most), min(high * chunk_size - 1, most - 1))
        else:
            own = chunk_of(table, key, chunk_size).between(low, high - 1)
        found = found | own
    return found


def table_diff(
    primary: DataFrame, replica: DataFrame, key: str, columns: Sequence[str], chunk_size: int = 1000
) -> DataFrame:
    """Keys that differ, with missing (on the replica), extra or changed.

    Keys may be repeated, of any type, or NULL: the rows of a key are compared as a whole, in any
    order. Both tables are read once for their trees of chunk digests (:func:`hash_tree`); then only the
    key ranges of the nodes that differ are read again, by filters that reach the scans. The trees are
    made and walked when the query is built.
    """
    leaves = [stored(table_checksum(t, key, columns, chunk_size), "chunks") for t in (primary, replica)]
    height = tree_height(*leaves)
    trees = [stored(hash_tree(t, height), "hash-tree") if height else hash_tree(t, 0) for t in leaves]
    level, nodes = differing_nodes(*trees, height)

    def rows(table: DataFrame) -> DataFrame:
        kept = table.filter(_within(table, key, chunk_size, level, nodes))
        return kept.groupBy(key).agg(*_combined(row_digest([key, *columns])))

    state = (
        F.when(F.col("r_row_count").isNull(), "missing")
        .when(F.col("p_row_count").isNull(), "extra")
        .otherwise("changed")
    )
    return _differing(rows(primary), rows(replica), key).select(key, state.alias("state"))


def checksum_tables(
    tables: dict[tuple[str, str], tuple[DataFrame, DataFrame, str, Sequence[str]]],
    databases: Sequence[str] | None = None,
    only_tables: Sequence[str] | None = None,
    ignored_databases: Sequence[str] = IGNORED_DATABASES,
    ignored_tables: Sequence[str] = (),
    chunk_size: int = 1000,
    method: str = "xxhash64",
) -> DataFrame:
    """Differing chunks of many tables in one DataFrame: (database_name, table_name, chunk, …).

    ``tables`` maps (database, table) to (primary, replica, key, columns); the lists choose which
    of them are compared.
    """
    chosen = {
        (db, name): spec
        for (db, name), spec in tables.items()
        if (databases is None or db in databases)
        and (only_tables is None or name in only_tables)
        and db not in ignored_databases
        and name not in ignored_tables
    }
    if not chosen:
        raise ValueError("no table left to compare")
    return reduce(
        DataFrame.unionByName,
        [
            checksum_diff(primary, replica, key, columns, chunk_size, method).select(
                F.lit(db).alias("database_name"), F.lit(name).alias("table_name"),
                "chunk", "primary_rows", "replica_rows",
            )
            for (db, name), (primary, replica, key, columns) in chosen.items()
        ],
    )
