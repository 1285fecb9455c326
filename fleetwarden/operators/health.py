"""Health checks: backups, error logs, partition horizon, replication."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.text import contains_any, record_value
from fleetwarden.functions.times import from_day_number, log_prefixes, midnight, time_literal
from fleetwarden.operators.collect import BACKUP_COMPLETE
from fleetwarden.operators.concat import MAX_CELL_BYTES, ordered_concat
from fleetwarden.operators.grams import gram_index, holding
from fleetwarden.operators.lookup import look_up

# Limits and report texts.
REPLICATION_MAX_LAG = 18000
ERROR_LOG_MAX_BYTES = 15 * 1024**3
MISSING_BACKUP_TEXT = "No backups found yesterday"
REPORT_RULE, REPORT_HEADER, REPORT_CONTEXT = "--", "status,warning,", "Changed database context"
PARTITION_SYSTEM_SCHEMAS = ["information_schema", "performance_schema", "mysql", "test"]
MAXVALUE = "MAXVALUE"

# Harmless messages of the database server, dropped from error logs. A fleet adds
# the ones of its own (accounts, events, hosts) from its pattern file.
HARMLESS_LOG_MESSAGES = [
    "[Note] Error reading relay log event: slave SQL thread was killed",
    "[Note] Slave SQL thread initialized, starting replication",
    "[Note] Slave SQL thread exiting, replication stopped",
    "[Warning] Slave SQL: If a crash happens this configuration does not guarantee that the relay log info will be consistent",
    "[Warning] Aborted connection",
    "No data - zero rows fetched, selected, or processed",
    "Slave SQL thread ignored the query because of replicate-*-",
    "was not purged because it was being readby thread number",
    "[Note] Start binlog_dump to slave_server",
    "[Warning] Storing MySQL user name or password information in the master info repository is not secure and is therefore not recommended. Please consider using the USER and PASSWORD connection options for START SLAVE; see the 'START SLAVE Syntax' in the MySQL Manual for more information",
    "[Warning] Slave I/O: Notifying master by SET @master_binlog_checksum= @@global.binlog_checksum failed with error: Unknown system variable 'binlog_checksum', Error_code: 1193",
    "[Warning] Slave I/O: Unknown system variable 'SERVER_UUID' on master. A probable cause is that the variable is not supported on the master (version: 5.5.9-log), even though it is on the slave (version: 5.6.19-67.0-log), Error_code: 1193",
    "InnoDB: Failed to set O_DIRECT on file",
    "InnoDB: O_DIRECT is known to result in 'Invalid argument' on Linux on tmpfs",
    "[Note] Slave I/O thread killed while reading event",
    "[Note] Slave I/O thread exiting, read up to log",
    "[Note] Slave I/O thread: connected to master",
    "[ERROR] Error reading packet from server: Lost connection to MySQL server during query ( server_errno=2013)",
    "[Note] Multi-threaded slave",
    "[Note] Coordinator",
]


def _yesterday(backups: DataFrame, as_of: str) -> Column:
    start = F.col("start")
    return start >= time_literal(backups, "start", midnight(as_of, -1))


def failed_backups(backups: DataFrame, servers: DataFrame, as_of: str) -> DataFrame:
    """Backups started since yesterday and ended before today whose status is not COMPLETE.

    No status counts as failed; no end (still running) does not.
    """
    today = time_literal(backups, "end", midnight(as_of))
    failed = backups.filter(
        _yesterday(backups, as_of)
        & (F.col("end") < today)
        & (F.coalesce("status", F.lit("")) != BACKUP_COMPLETE)
    )
    owners = servers.select(
        F.col("id").alias("dbserver_id"), "contact_id", "game_id", "location", "descr", "ip"
    )
    return failed.join(owners, "dbserver_id", "inner").select(
        "contact_id", "game_id", "location", "descr", "ip", "file", "start", "end",
        F.col("status").alias("failure_reason"),
    )


def missing_backups(
    backups: DataFrame,
    servers: DataFrame,
    as_of: str,
    where: Column | None = None,
    max_cell_bytes: int = MAX_CELL_BYTES,
) -> DataFrame:
    """Hosts whose smallest server id has no backup started yesterday, with their descriptions.

    A host is (contact, game, location, ip). Backups without a server id are ignored; a plain
    NOT IN would make the whole result empty because of one of them.
    """
    if where is not None:
        servers = servers.filter(where)
    host = ["contact_id", "game_id", "location", "ip"]
    today = time_literal(backups, "start", midnight(as_of))
    recent = backups.filter(_yesterday(backups, as_of) & (F.col("start") < today))
    seen = recent.select("dbserver_id").distinct()
    hosts = servers.groupBy(*host).agg(F.min("id").alias("dbserver_id"))
    missing = hosts.join(seen, "dbserver_id", "left_anti")
    same_host = functools.reduce(
        lambda a, b: a & b, [F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}")) for c in host]
    )
    members = servers.alias("s").join(missing.alias("m"), same_host, "left_semi")
    return ordered_concat(
        members, host, F.col("descr"), [F.col("id")], ",", out="descr", max_cell_bytes=max_cell_bytes
    ).withColumn("failure_reason", F.lit(MISSING_BACKUP_TEXT))


def backup_alert(
    backups: DataFrame, servers: DataFrame, as_of: str, where: Column | None = None
) -> DataFrame:
    """Failed and missing backups of every contact; missing ones have no file and no times.

    ``part_no`` orders the rows of a host whose descriptions take several cells.
    """
    failed = failed_backups(backups, servers, as_of)
    missing = missing_backups(backups, servers, as_of, where)
    failed = failed.withColumn("part_no", F.lit(0).cast("bigint"))
    for name in ("file", "start", "end"):
        missing = missing.withColumn(name, F.lit(None).cast(failed.schema[name].dataType))
    return failed.unionByName(missing)


def log_window(lines: DataFrame, as_of: str, interval: str, line: str = "line") -> DataFrame:
    """Lines dated in the wanted day or hour, in either date format; undated lines drop out."""
    old, new = log_prefixes(as_of, interval)
    return lines.filter(F.col(line).startswith(old) | F.col(line).startswith(new))


def log_exclude(
    lines: DataFrame, patterns: Sequence[str] = tuple(HARMLESS_LOG_MESSAGES), line: str = "line"
) -> DataFrame:
    """Lines that hold none of the fixed strings: one filter, no shuffle."""
    return lines.filter(~F.coalesce(contains_any(F.col(line), patterns), F.lit(False)))


def log_exclude_table(lines: DataFrame, patterns: DataFrame, line: str = "line", pattern: str = "pattern") -> DataFrame:
    """:func:`log_exclude` with the patterns in a table, for lists of any length.

    Each pattern is indexed by one of its grams (:mod:`grams`), the one that fewest patterns have, of the
    longest length that fits; lines are cut into grams of those lengths only that the patterns use, and
    only grams in a bitmap of the index leave the task that cuts them. The join that follows is a semi join:
    it can build the index, never the lines. What meets is checked on the whole pattern. Whether a line
    goes depends on its text alone, so lines need no identifier. An empty pattern matches every line;
    lines and patterns that are NULL match nothing. The index is made when the query is built.
    """
    index = gram_index(patterns.select(F.col(pattern).alias("_pattern")), "_pattern")
    texts = lines.select(F.col(line).alias("_text"))
    hits = holding(texts, "_text", index, F.contains("_text", "_pattern"))
    return look_up(lines.withColumn("_text", F.col(line)), hits, ["_text"], "left_anti").drop("_text")


def log_size_alarm(
    listing: DataFrame, limit: int = ERROR_LOG_MAX_BYTES, size: str = "size"
) -> DataFrame:
    """State of each log file from the size text: unreachable, oversize or ok; size in MiB."""
    numeric = F.when(F.col(size).rlike(r"^[0-9]+$"), F.col(size).try_cast("bigint"))
    state = (
        F.when(numeric.isNull(), "unreachable").when(numeric >= limit, "oversize").otherwise("ok")
    )
    mib = F.shiftright(numeric, 20)
    return listing.withColumn("size_mib", mib).withColumn("state", state)


def log_errors(
    lines: DataFrame,
    as_of: str,
    interval: str,
    patterns: Sequence[str] = tuple(HARMLESS_LOG_MESSAGES),
    server: str = "dbserver_id",
) -> DataFrame:
    """Servers with lines left after the time window and the exclusions, and how many."""
    left = log_exclude(log_window(lines, as_of, interval), patterns)
    return left.groupBy(server).agg(F.count("*").alias("error_lines"))


def partition_horizon(
    partitions: DataFrame,
    as_of: str,
    excluded_tables: Sequence[str] = (),
    system: Sequence[str] = tuple(PARTITION_SYSTEM_SCHEMAS),
) -> DataFrame:
    """RANGE-partitioned tables whose highest bound is not after tomorrow.

    Bounds are compared as numbers, and a MAXVALUE partition clears its table. The bound is an
    epoch or a day number according to the expression; other expressions have no date and are
    never reported. Tables are told apart by schema and, if given, by server.
    """
    keys = [k for k in ("dbserver_id",) if k in partitions.columns]
    keys += ["table_schema", "table_name", "partition_expression"]
    rows = partitions.filter(
        ~F.lower("table_schema").isin(list(system))
        & F.col("partition_name").isNotNull()
        & (F.col("partition_method") == "RANGE")
    )
    if excluded_tables:
        rows = rows.filter(~F.col("table_name").isin(list(excluded_tables)))
    text = F.col("partition_description")
    bounds = rows.groupBy(*keys).agg(
        F.max(F.when(text.rlike(r"^[0-9]+$"), text.try_cast("bigint"))).alias("last_bound"),
        F.coalesce(F.bool_or(text == MAXVALUE), F.lit(False)).alias("_open"),
    )
    expression = F.upper("partition_expression")
    bound_time = (
        F.when(expression.startswith("UNIX_TIMESTAMP"), F.timestamp_seconds("last_bound"))
        .when(expression.startswith("TO_DAYS"), from_day_number(F.col("last_bound")).cast("timestamp"))
    )
    horizon = F.lit(midnight(as_of, 1).isoformat(sep=" ")).cast("timestamp")
    return (
        bounds.withColumn("last_bound_time", bound_time)
        .filter(~F.col("_open") & (F.col("last_bound_time") <= horizon))
        .drop("_open")
    )


def lag_state(lag: Column, max_lag: int = REPLICATION_MAX_LAG) -> Column:
    """error when the lag text is not a number (NULL included), lag from ``max_lag`` on, else ok."""
    seconds = F.coalesce(lag.try_cast("decimal(38,0)"), F.lit(max_lag))
    return (
        F.when(lag.isNull() | ~lag.rlike(r"^[0-9]+$"), "error")
        .when(seconds >= max_lag, "lag")
        .otherwise("ok")
    )


def replication_health(
    status: DataFrame, lag: str = "lag", max_lag: int = REPLICATION_MAX_LAG
) -> DataFrame:
    """Status rows with their state. Rows may be servers, (server, channel) or subscriptions."""
    return status.withColumn("state", lag_state(F.col(lag), max_lag))


def replication_channels(
    records: DataFrame, record: str = "record", max_lag: int = REPLICATION_MAX_LAG
) -> DataFrame:
    """State per named channel from (dbserver_id, channel, record) status texts.

    Only the two fields needed are cut out of the text; ``parse_records`` gives all of them.
    """
    text = F.col(record)
    rows = records.select(
        *[c for c in records.columns if c != record],
        record_value(text, "Seconds_Behind_Master").alias("lag"),
        record_value(text, "Master_Host").alias("source_host"),
    )
    return replication_health(rows, max_lag=max_lag)


def replication_subscriptions(
    report: DataFrame, line: str = "line", max_lag: int = REPLICATION_MAX_LAG
) -> DataFrame:
    """State per subscription from the lines of a comma-separated report.

    Ruler, header and context lines drop out. The 1st, 3rd, 5th, 9th, 15th and 16th fields are
    status, subscriber, database, latency, last synchronisation and agent.
    """
    text = F.col(line)
    noise = text.startswith(REPORT_RULE) | text.startswith(REPORT_HEADER) | text.contains(REPORT_CONTEXT)
    rows = report.filter(~noise)
    field = F.split(text, ",", 17)  # the last field needed is the 16th
    places = {
        "status": 1, "subscriber": 3, "publisher_db": 5, "lag": 9, "last_sync": 15, "agent": 16,
    }
    rows = rows.select(
        *[c for c in report.columns if c != line],
        *[F.get(field, F.lit(n - 1)).alias(name) for name, n in places.items()],
    )
    return replication_health(rows, max_lag=max_lag)
