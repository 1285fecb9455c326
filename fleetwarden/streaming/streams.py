"""Error-log counts, snapshots and request sheets as streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetwarden.functions.text import contains_any
from fleetwarden.functions.times import log_time
from fleetwarden.operators.health import HARMLESS_LOG_MESSAGES
from fleetwarden.operators.lookup import look_up
from fleetwarden.operators.reconcile import new_state, reconcile, stage_dedupe
from fleetwarden.plans.jobs import run_pending
from fleetwarden.sources import buckets as bk
from fleetwarden.sources.sinks import append_rows, read_state

_THIS_RUN = "\0this run"  # stands for the run of each server until it is looked up


def stream_log_errors(
    lines: DataFrame,
    patterns: Sequence[str] = tuple(HARMLESS_LOG_MESSAGES),
    window: str = "1 hour",
    delay: str = "10 minutes",
    server: str = "dbserver_id",
) -> DataFrame:
    """Error lines per server and tumbling window, from a stream of (server, line).

    The same exclusions as the batch form. Lines later than ``delay`` are dropped by the watermark;
    state is one counter per (window, server) still open.
    """
    timed = lines.withColumn("log_time", log_time(F.col("line")))
    kept = timed.filter(
        F.col("log_time").isNotNull() & ~F.coalesce(contains_any(F.col("line"), patterns), F.lit(False))
    )
    return (
        kept.withWatermark("log_time", delay)
        .groupBy(F.window("log_time", window), server)
        .agg(F.count("*").alias("error_lines"))
        .select(server, F.col("window.start").alias("window_start"), "error_lines")
    )


def stream_snapshot(
    staged: DataFrame,
    base: str,
    initial: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str],
    server: str = "dbserver_id",
    run_column: str = "run_id",
    complete: str = "complete",
    buckets: int = bk.BUCKETS,
    **options,
) -> DataStreamWriter:
    """Reconcile staged rows into the state under ``base``, run by run of each server.

    Besides keys, payload and order the stream carries ``run_column`` and ``complete``. Rows of a run
    may come in any number of micro-batches; they are set aside until a row with ``complete`` true,
    which holds only server and run, says that the server's collection has ended. Then the server's
    stored rows are reconciled with the whole run, and only then may rows be deleted. Of several runs
    that end in one batch the last by name counts; the end of a run before the one that a server
    finished last is ignored. Rows and state lie in buckets of servers (:mod:`buckets`): a batch adds its
    rows, and reads and rewrites only the buckets of servers that it finished, so it reads the
    same however many batches came before. A batch that is run again replaces its own folders.
    ``buckets`` is for the life of the state: as many as servers' rows that one task should rewrite
    together allow. ``options`` go to ``reconcile``.
    """
    keys = list(keys)
    state_columns = _ddl(initial)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, batch_id + 1
        if batch_id == 0:
            first: bk.Manifest = {}
            bk.added(first, "state", 0, bk.write_buckets(initial.withColumn("_bucket", bk.bucket_of(server, buckets=buckets)), f"{base}/state", 0))
            bk.write_manifest(spark, base, 0, first)
            append_rows(initial.limit(0).coalesce(1), f"{base}/layout", 0)  # its columns, even if it has no row
        manifest = bk.read_manifest(spark, base, batch_id)
        ended = F.coalesce(F.col(complete), F.lit(False))
        batch = batch.withColumn("_bucket", bk.bucket_of(server, buckets=buckets))
        staged_columns = _ddl(batch.drop(complete, "_bucket"))
        bk.added(manifest, "staged", version, bk.write_buckets(batch.filter(~ended).drop(complete), f"{base}/staged", version))
        marks = batch.filter(ended).groupBy(server, "_bucket").agg(F.max(run_column).alias("_last"))
        touched = bk.write_buckets(marks, f"{base}/ended", version)
        if touched:
            bk.replaced(manifest, "ended", version, touched, touched)
            ends_columns = f"{_ddl(batch.select(server))}, _last {dict(batch.dtypes)[run_column]}"

            def read(table: str, columns: str) -> DataFrame:
                return bk.read_buckets(spark, f"{base}/{table}", manifest, table, touched, columns)

            before = read("finished", ends_columns).withColumnRenamed("_last", "_before")
            done = look_up(read("ended", ends_columns), before.drop("_bucket"), [server])
            done = done.filter(F.col("_before").isNull() | (F.col("_last") >= F.col("_before"))).drop("_before")
            last = done.select(server, "_last")
            arrived = look_up(read("staged", staged_columns), last, [server])
            whole = arrived.filter(F.col(run_column) == F.col("_last")).drop("_last", run_column, "_bucket")
            current = read("state", state_columns)
            finished = look_up(current, last.select(server), [server], "left_semi").drop("_bucket")
            merged = new_state(
                reconcile(finished, stage_dedupe(whole, keys, order), keys, payload, _THIS_RUN, server=server, run_column=run_column, **options)
            )
            named = F.when(F.col(run_column) == _THIS_RUN, F.col("_last")).otherwise(F.col(run_column))
            named_rows = look_up(merged, last, [server]).withColumn(run_column, named).drop("_last")
            others = look_up(current, last.select(server), [server], "left_anti").drop("_bucket")
            new = others.unionByName(named_rows.select(*others.columns)).withColumn("_bucket", bk.bucket_of(server, buckets=buckets))
            # Rows of the run that counts stay, in case its end is reported again; those before it go.
            kept = arrived.filter(F.col("_last").isNull() | (F.col(run_column) >= F.col("_last"))).drop("_last")
            ends = look_up(read("finished", ends_columns), last.select(server), [server], "left_anti").unionByName(done)
            for table, rows, folder in (("state", new, "state"), ("finished", ends, "finished")):
                bk.replaced(manifest, table, version, touched, bk.write_buckets(rows, f"{base}/{folder}", version))
            # Beside the batch's own rows, which this rewrites together with older ones.
            compact = bk.write_buckets(kept, f"{base}/staged", -version)
            bk.replaced(manifest, "staged", -version, touched, compact)
        bk.write_manifest(spark, base, version, manifest)

    return staged.writeStream.foreachBatch(merge)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)


def snapshot_state(spark: SparkSession, base: str, up_to: int) -> DataFrame:
    """The state of :func:`stream_snapshot` after ``up_to`` batches: the counting folder of each bucket."""
    manifest = bk.read_manifest(spark, base, up_to)
    columns = _ddl(read_state(spark, f"{base}/layout", 0))
    return bk.read_buckets(spark, f"{base}/state", manifest, "state", sorted(manifest), columns).drop("_bucket")


def stream_requests(
    sheet: DataFrame, base: str, ledger: DataFrame, run: Callable[[DataFrame], DataFrame]
) -> DataStreamWriter:
    """Run ``run`` once over the new requests of each micro-batch and record them as processed.

    Results go to ``base/result``, the ledger to ``base/ledger``, one folder per batch. A batch
    that is run again reads the ledger up to the batch before, and replaces its own folders.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            append_rows(ledger, f"{base}/ledger", 0)
        run_pending(batch, base, batch_id, run)

    return sheet.writeStream.foreachBatch(process)
