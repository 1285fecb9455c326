"""Health checks end to end: captured files in, one row per finding and contact out.

A captured file belongs to the server that its path names; ``pattern`` finds the number. Findings are (contact_id, dbserver_id, name, ...), ready for :func:`jobs.publish_alerts`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators import health as hl
from fleetwarden.operators.inventory import display_name, job_filter
from fleetwarden.operators.lookup import look_up
from fleetwarden.session import stored
from fleetwarden.sources import readers

REPLICATION_FORMS = ("replication_mysql", "replication_mariadb", "replication_mssql")


def server_of(file: Column, pattern: str = r"dbserver_id=(\d+)") -> Column:
    """The server's number in a path; NULL where there is none."""
    return F.nullif(F.regexp_extract(file, pattern, 1), F.lit("")).cast("int")


def _targets(servers: DataFrame, job: str) -> DataFrame:
    """The servers that a job checks, with what a finding says about them."""
    return servers.filter(job_filter(job)).select(
        F.col("id").alias("dbserver_id"), "contact_id", display_name().alias("name")
    )


def error_log_findings(
    spark: SparkSession,
    path: str,
    servers: DataFrame,
    as_of: str,
    interval: str,
    patterns: DataFrame | None = None,
    pattern: str = r"dbserver_id=(\d+)",
    max_bytes: int = hl.ERROR_LOG_MAX_BYTES,
) -> DataFrame:
    """(contact_id, dbserver_id, name, problem, line) of the error logs under ``path``.

    problem is ``unreachable`` for a server without a log, ``oversize`` for logs of ``max_bytes`` and
    more, whose lines are not looked at, else ``error``, one row for each line of the time window that
    holds neither a harmless message nor one of ``patterns`` (column pattern).
    """
    wanted = _targets(servers, "error_logs")
    listing = readers.read_listing(spark, path).withColumn("dbserver_id", server_of(F.col("path"), pattern))
    sizes = listing.groupBy("dbserver_id").agg(F.sum("length").cast("string").alias("size"))
    states = hl.log_size_alarm(look_up(wanted, sizes, ["dbserver_id"]), max_bytes)
    alarms = states.filter("state <> 'ok'").select(
        "contact_id", "dbserver_id", "name", F.col("state").alias("problem"), F.col("size").alias("line")
    )
    lines = readers.read_lines(spark, path).withColumn("dbserver_id", server_of(F.col("file"), pattern))
    left = hl.log_exclude(hl.log_window(lines.select("dbserver_id", "line"), as_of, interval))
    if patterns is not None:
        left = hl.log_exclude_table(left, patterns)
    good = states.filter("state = 'ok'").select("dbserver_id", "contact_id", "name")
    found = look_up(left, good.withColumn("_good", F.lit(True)), ["dbserver_id"]).filter("_good")
    errors = found.select("contact_id", "dbserver_id", "name", F.lit("error").alias("problem"), "line")
    return alarms.unionByName(errors)


def partition_findings(
    spark: SparkSession,
    path: str,
    servers: DataFrame,
    as_of: str,
    excluded_tables: tuple[str, ...] = (),
    pattern: str = r"dbserver_id=(\d+)",
) -> DataFrame:
    """Tables whose partitions end, of captured catalog output under ``path`` (tab-separated)."""
    rows = readers.read_tsv(spark, path, schemas.PARTITIONS, numbered=True)
    rows = rows.withColumn("dbserver_id", server_of(F.col("file"), pattern))
    due = hl.partition_horizon(rows, as_of, excluded_tables)
    return look_up(due, _targets(servers, "partitions").withColumn("_good", F.lit(True)), ["dbserver_id"]).filter("_good").select(
        "contact_id", "dbserver_id", "name", "table_schema", "table_name", "last_bound", "last_bound_time"
    )


def replication_findings(
    spark: SparkSession,
    path: str,
    servers: DataFrame,
    job: str,
    max_lag: int = hl.REPLICATION_MAX_LAG,
    pattern: str = r"dbserver_id=(\d+)",
) -> DataFrame:
    """(contact_id, dbserver_id, name, channel, lag, state) of all that does not replicate well.

    ``job`` is one of REPLICATION_FORMS: status records of replicas, the same with named channels, or
    the comma-separated report of a distributor, where a channel is a subscriber's database. A
    checked server without any status counts as an error. Only what checked servers left is parsed, once:
    the states are stored when the query is built, since both kinds of finding read them.
    """
    if job not in REPLICATION_FORMS:
        raise ValueError(f"unknown form {job!r}")
    wanted = _targets(servers, job)
    checked = wanted.select("dbserver_id")
    if job == "replication_mssql":
        lines = readers.read_report(spark, path).withColumn("dbserver_id", server_of(F.col("file"), pattern))
        lines = look_up(lines, checked, ["dbserver_id"], "left_semi")
        status = hl.replication_subscriptions(lines.select("dbserver_id", "line"), max_lag=max_lag)
        status = status.withColumn("channel", F.concat_ws(".", "subscriber", "publisher_db"))
    else:
        records = readers.read_records(spark, path).withColumn("dbserver_id", server_of(F.col("file"), pattern))
        records = look_up(records, checked, ["dbserver_id"], "left_semi")
        field = F.col("fields")
        status = records.select(
            "dbserver_id",
            (field["Connection_name"] if job == "replication_mariadb" else F.lit(None).cast("string")).alias("channel"),
            field["Seconds_Behind_Master"].alias("lag"),
        )
        status = hl.replication_health(status, max_lag=max_lag)
    seen = stored(status.select("dbserver_id", "channel", "lag", "state"), "replication-status")
    found = look_up(seen, wanted.withColumn("_good", F.lit(True)), ["dbserver_id"]).filter("_good and state <> 'ok'")
    silent = look_up(wanted, seen.select("dbserver_id", F.lit(True).alias("_seen")).distinct(), ["dbserver_id"]).filter("_seen is null")
    columns = ["contact_id", "dbserver_id", "name", "channel", "lag", "state"]
    silent = silent.withColumn("state", F.lit("error"))
    for name in ("channel", "lag"):
        silent = silent.withColumn(name, F.lit(None).cast("string"))
    return found.select(*columns).unionByName(silent.select(*columns))
