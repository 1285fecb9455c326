"""Snapshot reconcile: staged rows against the stored state, by natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.lookup import has_all, look_up


def stage_dedupe(staged: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; rows with a NULL key column are left out.

    A min over a struct rather than a window: it is reduced map-side, so a key repeated in a
    third of all rows costs no single task more than one row per map task.
    """
    rest = [c for c in staged.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    return staged.filter(has_all(keys)).groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in staged.columns]
    )


def null_key_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The staged rows that :func:`stage_dedupe` leaves out, for a report."""
    return staged.filter(~has_all(keys))


def protected_servers(outcomes: DataFrame, run_id: str) -> DataFrame:
    """Servers whose collection failed in this run: their stored rows must not be deleted."""
    return outcomes.filter((F.col("run_id") == run_id) & ~F.col("ok")).select("dbserver_id").distinct()


def _clearable(
    rows: DataFrame, scope: DataFrame | None, protected: DataFrame | None, server: str
) -> DataFrame:
    """Add ``_clearable``: the row's server is in scope (no list: every server) and not protected."""
    def listed(servers: DataFrame, flag: str) -> DataFrame:
        ids = servers.select(F.col(servers.columns[0]).alias(server)).distinct()
        return ids.withColumn(flag, F.lit(True))

    if scope is None and protected is None:
        return rows.withColumn("_clearable", F.lit(True))
    if scope is None:
        rows = look_up(rows, listed(protected, "_protected"), [server])
        return rows.withColumn("_clearable", F.col("_protected").isNull()).drop("_protected")
    flags = listed(scope, "_clearable")
    if protected is not None:
        # The two small lists meet first, so that the rows are joined by server only once.
        flags = flags.join(listed(protected, "_protected"), server, "left_anti")
    rows = look_up(rows, flags, [server])
    return rows.withColumn("_clearable", F.coalesce("_clearable", F.lit(False)))


def reconcile(
    current: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    run_id: str,
    *,
    scope: DataFrame | None = None,
    protected: DataFrame | None = None,
    server: str = "dbserver_id",
    run_column: str = "run_id",
    first_seen: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Current and staged rows merged; ``change`` is insert, update, delete or keep.

    update: the key is staged; payload comes from staging, NULLs included, and every other column
    stays. insert: the key is new; ``first_seen`` is set to ``as_of`` and columns that staging
    lacks are NULL. delete: not staged, its server in ``scope`` and not ``protected``. keep: the
    rest. No ``scope`` means every server. Keys must be unique on both sides (:func:`stage_dedupe`).
    :func:`new_state` gives the state to store.
    """
    keys, payload = list(keys), list(payload)
    old = current.withColumn("_old", F.lit(True))
    new = staged.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in payload], F.lit(True).alias("_new")
    )
    rows = old.join(new, keys, "full_outer")
    rows = _clearable(rows, scope, protected, server)

    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    change = (
        F.when(is_old & is_new, "update")
        .when(is_new, "insert")
        .when(F.col("_clearable"), "delete")
        .otherwise("keep")
    )

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in payload:
            return F.when(is_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c == run_column:
            return F.when(is_new, F.lit(run_id)).otherwise(F.col(c)).alias(c)
        if c == first_seen:
            stamp = F.lit(as_of).cast(current.schema[c].dataType)
            return F.when(is_old, F.col(c)).otherwise(stamp).alias(c)
        return F.col(c)

    return rows.select(*[value(c) for c in current.columns], change.alias("change"))


def new_state(reconciled: DataFrame) -> DataFrame:
    return reconciled.filter(F.col("change") != "delete").drop("change")


def change_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("change").agg(F.count("*").alias("row_count"))


def insert_ignore(
    current: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    first_seen: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Current rows plus the staged rows whose key is absent; stored rows are not touched."""
    fresh = staged.join(current.select(*keys), list(keys), "left_anti")
    if first_seen:
        fresh = fresh.withColumn(first_seen, F.lit(as_of).cast(current.schema[first_seen].dataType))
    return current.unionByName(fresh, allowMissingColumns=True)


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite ``columns`` of matched target rows, NULLs included; other rows keep theirs.

    ``source`` must be unique by ``keys``.
    """
    new = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    return look_up(target, new, list(keys)).select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        ]
    )


def delete_obsolete(
    state: DataFrame,
    run_id: str,
    *,
    scope: DataFrame | None = None,
    protected: DataFrame | None = None,
    server: str = "dbserver_id",
    run_column: str = "run_id",
) -> DataFrame:
    """The state without rows that this run did not see, in scope and not protected.

    A row without a run id is never obsolete, as the comparison with NULL is not true.
    """
    rows = _clearable(state, scope, protected, server)
    obsolete = (F.col(run_column) != run_id) & F.col("_clearable")
    return rows.filter(~F.coalesce(obsolete, F.lit(False))).select(*state.columns)
