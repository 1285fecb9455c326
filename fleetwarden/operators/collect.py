"""Collection of sessions, objects, accounts and backups into staged snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.text import directory, strip_counter
from fleetwarden.functions.times import backup_start
from fleetwarden.operators.concat import MAX_CELL_BYTES, ordered_concat
from fleetwarden.operators.reconcile import update_from

# Schemas and databases that belong to the server itself.
MYSQL_SYSTEM_SCHEMAS = [
    "information_schema", "performance_schema", "mysql", "percona", "test", "tmp", "temp", "pt-dsns",
]
MSSQL_SYSTEM_DATABASES = ["master", "tempdb", "model", "msdb"]
MSSQL_GRANT_SKIPPED_DATABASES = ["tempdb", "model", "msdb"]
# Object types, the success mark of a backup log and its status word.
OBJECT_TYPES = ["table", "view", "event", "trigger", "procedure"]
BACKUP_OK_MARK = ": completed OK"
BACKUP_COMPLETE = "COMPLETE"


def session_counts(processlist: DataFrame) -> DataFrame:
    """Sessions by (server, user, host without port) from (dbserver_id, user_name, host)."""
    return processlist.groupBy(
        "dbserver_id", "user_name", F.substring_index("host", ":", 1).alias("user_host")
    ).agg(F.count("*").alias("session_count"))


def session_totals(sessions: DataFrame) -> DataFrame:
    """Connected (user, host) pairs and total connections per server."""
    return sessions.groupBy("dbserver_id").agg(
        F.count("*").alias("users"), F.sum("session_count").alias("connections")
    )


def object_snapshot(catalogs: dict[str, DataFrame]) -> DataFrame:
    """One row per object: (dbserver_id, dbschema, type, name, definition).

    ``catalogs`` maps each of ``OBJECT_TYPES`` to (dbserver_id, dbschema, name, definition);
    functions arrive among the procedures. Only table definitions carry a counter to strip.
    """
    unknown = set(catalogs) - set(OBJECT_TYPES)
    if unknown or not catalogs:
        raise ValueError(f"object types must be among {OBJECT_TYPES}, not {sorted(unknown)}")
    parts = []
    for kind in OBJECT_TYPES:
        if kind in catalogs:
            text = F.col("definition")
            text = strip_counter(text) if kind == "table" else text
            parts.append(
                catalogs[kind].select(
                    "dbserver_id", "dbschema", F.lit(kind).alias("type"), "name",
                    text.alias("definition"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def normalise_definition(objects: DataFrame, column: str = "definition") -> DataFrame:
    return objects.withColumn(column, strip_counter(F.col(column)))


def table_ddl(
    columns: DataFrame,
    types: DataFrame,
    key_columns: DataFrame,
    keys: Sequence[str] = ("object",),
    max_cell_bytes: int = MAX_CELL_BYTES,
) -> DataFrame:
    """``CREATE TABLE t col type(len) [Primary Key],…`` per table, columns in order.

    columns: (keys, column_id, name, user_type_id, max_length); types: (user_type_id, name);
    key_columns: (keys, column_id) of primary-key members. The last of ``keys`` is the table name.
    """
    keys = list(keys)
    kinds = types.select("user_type_id", F.col("name").alias("type_name"))
    primary = key_columns.select(*keys, "column_id").distinct().withColumn("_key", F.lit("Primary Key"))
    described = columns.join(kinds, "user_type_id", "inner").join(primary, [*keys, "column_id"], "left")
    text = F.concat(
        "name", F.lit(" "), "type_name", F.lit("("), F.col("max_length").cast("string"), F.lit(") "),
        F.coalesce("_key", F.lit("")), F.lit(","),
    )
    head = F.concat(F.lit("CREATE TABLE "), F.col(keys[-1]).cast("string"))
    return ordered_concat(
        described, keys, text, [F.col("column_id")], " ", max_cell_bytes=max_cell_bytes, head=head
    )


def schema_list(
    schemata: DataFrame, system: Sequence[str] = tuple(MYSQL_SYSTEM_SCHEMAS), online_only: bool = False
) -> DataFrame:
    """Schemas that users own; ``online_only`` keeps databases whose state_desc is ONLINE."""
    rows = schemata.filter(~F.lower("schema_name").isin([s.lower() for s in system]))
    return rows.filter(F.upper("state_desc") == "ONLINE") if online_only else rows


def grant_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Cut ``Grants for user@host: GRANT …`` lines into (account, statement); others drop out.

    Only the first ``': '`` separates, so a statement may hold another one.
    """
    body = F.split(F.regexp_extract(F.col(line), r"(?s)Grants for (.*)$", 1), ": ", 2)
    return (
        lines.filter(F.col(line).contains("Grants for "))
        .withColumn("account", body[0])
        .withColumn("statement", F.get(body, F.lit(1)))
        .drop(line)
    )


def grants_concat(
    grants: DataFrame, order: Sequence[str] = ("line_no",), max_cell_bytes: int = MAX_CELL_BYTES
) -> DataFrame:
    """All grants of an account in input order, each followed by ``; ``."""
    return ordered_concat(
        grants,
        ["dbserver_id", "account"],
        F.concat("statement", F.lit("; ")),
        [F.col(c) for c in order],
        max_cell_bytes=max_cell_bytes,
    )


def _user_name(c: str = "name") -> Column:
    return ~F.col(c).startswith("#")


def _quoted(c: Column | str) -> Column:
    return F.concat(F.lit("["), c, F.lit("]"))


def grant_statements(
    principals: DataFrame,
    role_members: DataFrame,
    server_permissions: DataFrame,
    db_permissions: DataFrame,
    db_members: DataFrame,
) -> DataFrame:
    """Statements that rebuild logins and permissions: (dbserver_id, name, step, statement).

    principals: (dbserver_id, principal_id, name, type, password_hash, default_database_name,
    default_language_name, is_disabled); role_members: (dbserver_id, role_principal_id,
    member_principal_id); server_permissions: (dbserver_id, grantee_principal_id,
    permission_name); db_permissions: (dbserver_id, database_name, grantee_principal_id,
    grantee_name, grantee_type_desc, permission_name, class_desc, state_desc, object_name);
    db_members: (dbserver_id, database_name, member_uid, member_name, group_name).
    All databases are rows of one table, so there is no loop over them.
    """
    # The texts of the statements and the names of the steps, as the server and the
    # stored definitions have them.
    server = ["dbserver_id"]

    def rows(df: DataFrame, name: Column, step: Column, statement: Column) -> DataFrame:
        return df.select(
            *server, name.alias("name"), step.alias("step"), F.rtrim(statement).alias("statement")
        )

    name = F.col("name")
    disabled = F.when(
        F.col("is_disabled") == 1, F.concat(F.lit(" ALTER LOGIN "), _quoted(name), F.lit(" DISABLED; "))
    ).otherwise("")
    sql_login = F.concat(
        F.lit("CREATE LOGIN "), _quoted(name), F.lit(" WITH PASSWORD="), "password_hash",
        F.lit(" HASHED,DEFAULT_DATABASE="), _quoted("default_database_name"),
        F.lit(", DEFAULT_LANGUAGE="), _quoted("default_language_name"), F.lit("; "), disabled,
    )
    windows_login = F.concat(F.lit("CREATE LOGIN "), _quoted(name), F.lit(" FROM WINDOWS; "), disabled)
    logins = rows(
        principals.filter(F.col("type").isin("S", "U") & _user_name()),
        name,
        F.lit("1login"),
        F.when(F.col("type") == "S", sql_login).otherwise(windows_login),
    )

    roles = principals.select(
        *server, F.col("principal_id").alias("role_principal_id"), name.alias("role_name")
    )
    members = principals.select(*server, F.col("principal_id").alias("member_principal_id"), "name")
    server_roles = rows(
        role_members.join(roles, [*server, "role_principal_id"], "inner").join(
            members, [*server, "member_principal_id"], "inner"
        ),
        name,
        F.lit("2role"),
        F.concat(F.lit("EXEC sp_addsrvrolemember '"), name, F.lit("','"), "role_name", F.lit("'; ")),
    )

    grantees = principals.filter(F.col("type").isin("U", "S") & _user_name()).select(
        *server, F.col("principal_id").alias("grantee_principal_id"), "name"
    )
    server_grants = rows(
        server_permissions.filter(F.col("permission_name") != "CONNECT SQL").join(
            grantees, [*server, "grantee_principal_id"], "inner"
        ),
        name,
        F.lit("3priv"),
        F.concat(F.lit("GRANT "), "permission_name", F.lit(" TO "), _quoted(name), F.lit("; ")),
    )

    database, grantee = F.col("database_name"), F.col("grantee_name")
    kept_database = ~F.lower(database).isin(MSSQL_GRANT_SKIPPED_DATABASES)
    right = F.concat("state_desc", F.lit(" "), "permission_name")
    db_grants = rows(
        db_permissions.filter(
            kept_database
            & (F.col("grantee_type_desc") == "SQL_USER")
            & (F.col("grantee_principal_id") != 1)
            & _user_name("grantee_name")
        ),
        grantee,
        F.concat(F.lit("4dbpriv-"), database, F.lit("-"), "permission_name"),
        F.when(
            F.col("permission_name") == "CONNECT",
            F.concat(
                F.lit("USE "), _quoted(database), F.lit("; CREATE USER "), _quoted(grantee), F.lit("; ")
            ),
        )
        .when(
            F.col("class_desc") == "DATABASE",
            F.concat(right, F.lit(" TO "), _quoted(grantee), F.lit("; ")),
        )
        .otherwise(
            F.concat(right, F.lit(" ON "), "object_name", F.lit(" TO "), _quoted(grantee), F.lit("; "))
        ),
    )

    member = F.col("member_name")
    db_roles = rows(
        db_members.filter(kept_database & (F.col("member_uid") != 1) & _user_name("member_name")),
        member,
        F.concat(F.lit("5dbrole-"), database),
        F.concat(
            F.lit("USE "), _quoted(database), F.lit("; EXEC sp_addrolemember '"), "group_name",
            F.lit("','"), member, F.lit("'; "),
        ),
    )
    return reduce(DataFrame.unionByName, [logins, server_roles, server_grants, db_grants, db_roles])


def grants_ordered_concat(
    statements: DataFrame, max_cell_bytes: int = MAX_CELL_BYTES
) -> DataFrame:
    """Statements of each name in (step, text) order, each followed by a blank, as ``name@%``."""
    rows = statements.withColumn("account", F.concat("name", F.lit("@%")))
    return ordered_concat(
        rows,
        ["dbserver_id", "account"],
        F.concat("statement", F.lit(" ")),
        [F.col("step"), F.col("statement")],
        max_cell_bytes=max_cell_bytes,
    )


def account_definition(accounts: DataFrame, grants: DataFrame) -> DataFrame:
    """Accounts with their grants attached by ``user@host``, one statement per line.

    The literal password ``NULL`` becomes NULL. An account without grants keeps its definition.
    Grants so large that they come in parts give one row per part, numbered by ``part_no``.
    """
    lines = grants.select(
        "dbserver_id",
        F.col("account").alias("_account"),
        "part_no",
        F.replace("definition", F.lit("; "), F.lit(";\n")).alias("_definition"),
    )
    keyed = accounts.withColumn("_account", F.concat("user_name", F.lit("@"), "user_host"))
    on = ["dbserver_id", "_account"]
    # Two joins rather than one left join: in an inner join adaptive execution can split the many
    # parts of a very large account, on the right of a left join it cannot.
    with_grants = lines.join(keyed, on, "inner")
    without = keyed.join(lines.select(*on), on, "left_anti")
    password = F.nullif("password", F.lit("NULL")).alias("password")

    def rows(df: DataFrame, definition: Column, part: Column) -> DataFrame:
        values = {"password": password, "definition": definition.alias("definition")}
        return df.select(*[values.get(c, F.col(c)) for c in accounts.columns], part.alias("part_no"))

    return rows(with_grants, F.col("_definition"), F.col("part_no")).unionByName(
        rows(without, F.col("definition"), F.lit(0).cast("bigint"))
    )


def login_list(principals: DataFrame) -> DataFrame:
    """SQL and Windows logins as staged account rows; names starting with ``#`` are the server's."""
    return principals.filter(F.col("type").isin("U", "S") & _user_name()).select(
        "dbserver_id",
        F.col("name").alias("user_name"),
        F.lit("%").alias("user_host"),
        F.col("password_hash").alias("password"),
        F.lit(0).alias("max_user_connections"),
        F.lit(None).cast("string").alias("definition"),
    )


def backup_files(listing: DataFrame) -> DataFrame:
    """Staged backups from (dbserver_id, path, length, modified): start is read from the path."""
    return listing.select(
        "dbserver_id",
        F.col("path").alias("file"),
        F.col("length").alias("size"),
        backup_start(F.col("path")).alias("start"),
        F.col("modified").alias("end"),
    )


def backup_status(log_lines: DataFrame, files: DataFrame, ok_mark: str = BACKUP_OK_MARK) -> DataFrame:
    """Per log its status, with the last file of the log's directory.

    log_lines: (dbserver_id, log, line_no, line); files: (dbserver_id, path). The status is
    COMPLETE if a line holds ``ok_mark``, else the last line. Both sides are reduced map-side, so
    a log of any size never sits in one task.
    """
    logs = log_lines.groupBy("dbserver_id", "log").agg(
        F.bool_or(F.col("line").contains(ok_mark)).alias("_ok"),
        F.max_by("line", "line_no").alias("_last"),
    )
    newest = files.groupBy("dbserver_id", directory(F.col("path")).alias("_dir")).agg(
        F.max("path").alias("file")
    )
    return (
        logs.withColumn("_dir", directory(F.col("log")))
        .join(newest, ["dbserver_id", "_dir"], "left")
        .select(
            "dbserver_id",
            "log",
            F.when(F.col("_ok"), BACKUP_COMPLETE).otherwise(F.col("_last")).alias("status"),
            "file",
        )
    )


def apply_backup_status(backups: DataFrame, statuses: DataFrame) -> DataFrame:
    """Set the status of the named files; of several logs naming one file the last log wins."""
    last = (
        statuses.filter(F.col("file").isNotNull())
        .groupBy("dbserver_id", "file")
        .agg(F.max_by("status", "log").alias("status"))
    )
    return update_from(backups, last, ["dbserver_id", "file"], ["status"])
