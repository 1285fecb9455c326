"""End-to-end jobs: read what was collected, reconcile it with the stored state, write, report.

All sites are handled in one job; a site, where given, narrows the delete scope only. State is
kept as numbered versions, and each job writes version + 1 from version.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators import collect as col
from fleetwarden.operators import reconcile as rec
from fleetwarden.operators import reports as rep
from fleetwarden.operators import requests as rq
from fleetwarden.operators.inventory import MSSQL, MYSQL_LIKE, job_filter
from fleetwarden.sources import readers, sinks

FILE_ORDER = ["file", "line_no"]


@dataclass(frozen=True)
class Snapshot:
    """What identifies a stored row, what a run overwrites, and which servers a run may clear."""

    keys: tuple[str, ...]
    payload: tuple[str, ...]
    jobs: tuple[str, ...]
    first_seen: str | None = None


SNAPSHOTS = {
    "sessions": Snapshot(
        ("dbserver_id", "user_name", "user_host"), ("session_count",), ("sessions",), "creation_date"
    ),
    "accounts": Snapshot(
        ("dbserver_id", "user_name", "user_host", "part_no"),
        ("password", "max_user_connections", "definition"),
        ("accounts_mysql", "accounts_mssql"),
    ),
    "objects": Snapshot(("dbserver_id", "dbschema", "name", "type", "part_no"), ("definition",), ("objects_mysql", "objects_mssql")),
    "backups": Snapshot(("dbserver_id", "file"), ("size", "start", "end"), ("backups",)),
}


def delete_scope(
    servers: DataFrame,
    snapshot: str,
    kinds: Sequence[str],
    game_id: str | None = None,
    location: str | None = None,
    ip: str | None = None,
) -> DataFrame:
    """Servers whose rows a run may delete: those of the collected kinds, at the site if given.

    The scope is made from the filters of the jobs that collect: a server that is not collected is
    not cleared. The kind is part of it, so that the runs for two kinds at one site do not delete
    each other's rows.
    """
    collected = reduce(lambda a, b: a | b, [job_filter(job) for job in SNAPSHOTS[snapshot].jobs])
    where = F.lower("dbtype").isin([k.lower() for k in kinds]) & collected
    site: list[Column] = [
        F.col(name) == value
        for name, value in (("game_id", game_id), ("location", location))
        if value is not None
    ]
    places = [reduce(lambda a, b: a & b, site)] if site else []
    places += [F.col("ip") == ip] if ip is not None else []
    if places:
        where &= reduce(lambda a, b: a | b, places)
    return servers.filter(where).select(F.col("id").alias("dbserver_id"))


def store_snapshot(
    staged: DataFrame,
    base: str,
    version: int,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str],
    run_id: str,
    **options,
) -> DataFrame:
    """Reconcile staged rows with a stored version and write the next one; returns it.

    Rows with a NULL key cannot be stored; they go to a folder beside the state, its name with ``-rejected`` added.
    """
    spark = staged.sparkSession
    sinks.append_rows(rec.null_key_rows(staged, keys), f"{base.rstrip('/')}-rejected", version + 1)
    rows = rec.stage_dedupe(staged, keys, order)
    current = sinks.read_state(spark, base, version)
    merged = rec.reconcile(current, rows, keys, payload, run_id, **options)
    sinks.write_state(rec.new_state(merged), base, version + 1)
    return sinks.read_state(spark, base, version + 1)


def _store(name: str, staged, base, version, run_id, order, scope, outcomes, as_of=None) -> DataFrame:
    spec = SNAPSHOTS[name]
    protected = None if outcomes is None else rec.protected_servers(outcomes, run_id)
    return store_snapshot(
        staged, base, version, spec.keys, spec.payload, order, run_id,
        scope=scope, protected=protected, first_seen=spec.first_seen, as_of=as_of,
    )


def collect_sessions(
    spark: SparkSession,
    path: str,
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    as_of: str,
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Session counts of a run into the session state."""
    staged = readers.read_tsv(spark, path, schemas.STAGED_SESSIONS, numbered=True)
    scope = delete_scope(servers, "sessions", MYSQL_LIKE, **site)
    return _store("sessions", staged, base, version, run_id, FILE_ORDER, scope, outcomes, as_of)


def collect_accounts(
    accounts: DataFrame,
    grants: DataFrame,
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    kinds: Sequence[str] = tuple(MYSQL_LIKE),
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Accounts with their concatenated grants into the account state.

    An account whose grants exceed the size of a cell is stored as several rows, told apart by
    ``part_no``, which is part of the key in the state.
    """
    spec = SNAPSHOTS["accounts"]
    staged = col.account_definition(accounts, grants)
    protected = None if outcomes is None else rec.protected_servers(outcomes, run_id)
    order = [c for c in FILE_ORDER if c in accounts.columns] or ["password"]
    return store_snapshot(
        staged, base, version, spec.keys, spec.payload, order, run_id,
        scope=delete_scope(servers, "accounts", kinds, **site), protected=protected,
    )


def read_accounts(spark: SparkSession, path: str, escapes: bool = True) -> DataFrame:
    """Staged accounts of a file, numbered; the other vendor's files hold no escapes."""
    return readers.read_tsv(spark, path, schemas.STAGED_ACCOUNTS, escapes=escapes, numbered=True)


def read_grants(spark: SparkSession, path: str, server: Column) -> DataFrame:
    """Concatenated grants of captured grant output; ``server`` is cut from the column ``file``."""
    lines = readers.read_lines(spark, path).withColumn("dbserver_id", server.cast("int"))
    return col.grants_concat(col.grant_lines(lines), order=FILE_ORDER)


def collect_objects(
    spark: SparkSession,
    path: str,
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    kinds: Sequence[str] = tuple(MYSQL_LIKE),
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Object definitions of a run, without counters, into the object state."""
    staged = readers.read_tsv(spark, path, schemas.STAGED_OBJECTS, numbered=True)
    staged = col.normalise_definition(staged).withColumn("part_no", F.lit(0).cast("bigint"))
    scope = delete_scope(servers, "objects", kinds, **site)
    return _store("objects", staged, base, version, run_id, FILE_ORDER, scope, outcomes)


def collect_captured_objects(
    spark: SparkSession,
    paths: dict[str, str],
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    kinds: Sequence[str] = tuple(MYSQL_LIKE),
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Object definitions of captured catalog output (object type to path) into the object state."""
    staged = col.object_snapshot({kind: readers.read_catalog(spark, path, kind) for kind, path in paths.items()})
    staged = staged.withColumn("part_no", F.lit(0).cast("bigint"))
    scope = delete_scope(servers, "objects", kinds, **site)
    return _store("objects", staged, base, version, run_id, ["definition"], scope, outcomes)


def collect_built_objects(
    columns: DataFrame,
    types: DataFrame,
    key_columns: DataFrame,
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    kinds: Sequence[str] = (MSSQL,),
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Table definitions built from catalog rows (keys dbserver_id, dbschema, object) into the object state.

    A definition larger than a cell is stored as several rows, told apart by ``part_no``.
    """
    staged = col.table_ddl(columns, types, key_columns, ["dbserver_id", "dbschema", "object"])
    staged = staged.withColumnRenamed("object", "name").withColumn("type", F.lit("table"))
    scope = delete_scope(servers, "objects", kinds, **site)
    return _store("objects", staged, base, version, run_id, ["definition"], scope, outcomes)


def collect_backups(
    listing: DataFrame,
    log_lines: DataFrame,
    base: str,
    version: int,
    run_id: str,
    servers: DataFrame,
    outcomes: DataFrame | None = None,
    **site,
) -> DataFrame:
    """Backup files of a run into the backup state, then the status read from the logs.

    Writes version + 1 with the files and version + 2 with the status.
    """
    scope = delete_scope(servers, "backups", MYSQL_LIKE, **site)
    state = _store(
        "backups", col.backup_files(listing), base, version, run_id, ["start", "end"], scope, outcomes
    )
    status = col.backup_status(log_lines, listing)
    sinks.write_state(col.apply_backup_status(state, status), base, version + 2)
    return sinks.read_state(listing.sparkSession, base, version + 2)


def publish_dictionary(objects: DataFrame, dictionary: DataFrame, path: str) -> None:
    """The data dictionary as report rows, one folder per server and schema.

    Entries whose pattern cannot be used go to a folder beside it, its name with ``-rejected`` added.
    """
    entries, rejected = rep.usable_entries(dictionary)
    rejected.write.mode("overwrite").json(f"{path.rstrip('/')}-rejected")
    rows = rep.dictionary_rows(rep.dictionary_report(objects, entries))
    ordered = rows.sort("dbserver_id", "dbschema", "name", "part_no")
    ordered.select("dbserver_id", "dbschema", "value").write.mode("overwrite").partitionBy(
        "dbserver_id", "dbschema"
    ).text(path)


def publish_alerts(alerts: DataFrame, path: str) -> None:
    """Alert rows, one folder per contact."""
    rep.alert_rows(alerts).write.mode("overwrite").partitionBy("contact_id").text(path)


def run_pending(
    sheet: DataFrame, base: str, version: int, run: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Answer all new requests of a sheet at once and record them; returns the answers.

    The ledger of runs up to ``version`` is compared, ledger and answers are written as version
    + 1. A run that is repeated replaces its own folders and answers the same requests.
    """
    spark = sheet.sparkSession
    done = sinks.read_appended(spark, f"{base}/ledger", version)
    sinks.append_rows(rq.pending_requests(sheet, done), f"{base}/ledger", version + 1)
    pending = sinks.read_state(spark, f"{base}/ledger", version + 1)
    sinks.append_rows(run(pending), f"{base}/result", version + 1)
    return sinks.read_state(spark, f"{base}/result", version + 1)


def issue_codes(
    requests: DataFrame, batches: DataFrame, base: str, version: int, seed: str, as_of: str
) -> DataFrame:
    """Check the quota of code requests, make the codes of the accepted ones, append them.

    Stored codes are ``base/codes`` up to ``version``. The requests of a batch are served in order,
    each seeing the codes of those before it. Returns all requests with their status.
    """
    spark = requests.sparkSession
    stored = sinks.read_appended(spark, f"{base}/codes", version)
    checked = rq.quota_in_order(requests, batches, stored)
    sinks.append_rows(checked, f"{base}/checked", version + 1)
    checked = sinks.read_state(spark, f"{base}/checked", version + 1)
    codes = rq.generate_codes(checked.filter("accepted"), stored, seed, run=str(version + 1))
    sinks.append_rows(rq.code_rows(codes, as_of), f"{base}/codes", version + 1)
    return checked

