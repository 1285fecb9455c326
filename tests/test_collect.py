import pytest
from pyspark.sql import functions as F

from fleetwarden.operators import collect as col
from fleetwarden.operators.concat import ordered_concat
from tests.conftest import rows


def test_sessions(table):
    raw = table(
        [(1, "u", "h:1"), (1, "u", "h:2"), (1, "u", "k"), (2, "u", "h:9"), (2, None, "h:9")],
        "dbserver_id int, user_name string, host string",
    )
    counts = col.session_counts(raw)
    assert rows(counts) == [(1, "u", "h", 2), (1, "u", "k", 1), (2, None, "h", 1), (2, "u", "h", 1)]
    assert rows(col.session_totals(counts)) == [(1, 2, 3), (2, 2, 2)]


def test_objects_and_counters(table):
    schema = "dbserver_id int, dbschema string, name string, definition string"
    got = col.object_snapshot(
        {
            "table": table([(1, "s", "t", "x AUTO_INCREMENT=12 y\n AUTO_INCREMENT=3")], schema),
            "view": table([(1, "s", "v", "x AUTO_INCREMENT=12")], schema),
        }
    )
    assert rows(got, "type", "definition") == [
        ("table", "x y\n AUTO_INCREMENT=3"), ("view", "x AUTO_INCREMENT=12"),
    ]
    with pytest.raises(ValueError):
        col.object_snapshot({"index": table([], schema)})


def test_table_ddl(table):
    columns = table(
        [("t", 2, "b", 7, 10), ("t", 1, "a", 5, 4), ("u", 3, "c", 5, 4)],
        "object string, column_id int, name string, user_type_id int, max_length int",
    )
    types = table([(5, "int"), (7, "varchar")], "user_type_id int, name string")
    keys = table([("t", 1), ("t", 1)], "object string, column_id int")
    want = [
        ("t", 0, "CREATE TABLE t a int(4) Primary Key, b varchar(10) ,"),
        ("u", 0, "CREATE TABLE u c int(4) ,"),
    ]
    assert rows(col.table_ddl(columns, types, keys)) == want
    parts = col.table_ddl(columns, types, keys, max_cell_bytes=30).orderBy("object", "part_no")
    whole = {}
    for r in parts.collect():
        whole.setdefault(r["object"], []).append(r["definition"])
    assert [(k, " ".join(v)) for k, v in sorted(whole.items())] == [(o, d) for o, _, d in want]


def test_schema_list(table):
    got = table(
        [("MySQL", "ONLINE"), ("shop", "ONLINE"), ("old", "OFFLINE"), ("pt-dsns", "ONLINE")],
        "schema_name string, state_desc string",
    )
    assert rows(col.schema_list(got), "schema_name") == [("old",), ("shop",)]
    assert rows(col.schema_list(got, online_only=True), "schema_name") == [("shop",)]


def test_grants_in_input_order(table):
    lines = table(
        [
            (1, 3, "Grants for a@%: GRANT SELECT ON x"),
            (1, 1, "Grants for a@%: GRANT USAGE: all"),
            (1, 2, "*** 1. row ***"),
            (1, 4, "Grants for b@h: GRANT ALL"),
        ],
        "dbserver_id int, line_no int, line string",
    )
    got = col.grants_concat(col.grant_lines(lines))
    assert rows(got) == [
        (1, "a@%", 0, "GRANT USAGE: all; GRANT SELECT ON x; "), (1, "b@h", 0, "GRANT ALL; "),
    ]


def test_account_definition(table):
    accounts = table(
        [(1, "a", "%", "NULL", 0, "old"), (1, "b", "h", "0xAB", 5, "old"), (2, "a", "%", None, 0, None)],
        "dbserver_id int, user_name string, user_host string, password string, "
        "max_user_connections int, definition string",
    )
    grants = table(
        [(1, "a@%", 0, "G1; G2; ")], "dbserver_id int, account string, part_no bigint, definition string"
    )
    assert rows(col.account_definition(accounts, grants)) == [
        (1, "a", "%", None, 0, "G1;\nG2;\n", 0),
        (1, "b", "h", "0xAB", 5, "old", 0),
        (2, "a", "%", None, 0, None, 0),
    ]


def test_large_groups_come_in_ordered_parts(spark):
    """One key holds a third of all rows; its parts, joined in order, are the whole text."""
    data = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        F.col("id").alias("n"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
    )
    data = data.unionByName(spark.sql("select cast(null as bigint) k, 5L n, 'lone' text"))
    want = ";".join(f"t{i}" for i in range(0, 9000, 3))
    for bound in (2000, 15000):
        got = ordered_concat(data, ["k"], F.col("text"), [F.col("n")], ";", max_cell_bytes=bound, last=["n"])
        parts = got.filter("k = -1").orderBy("part_no").collect()
        assert len(parts) > 1 and max(len(p["definition"]) for p in parts) <= bound
        assert ";".join(p["definition"] for p in parts) == want and parts[-1]["n"] == 8997
        assert {r["k"]: r["definition"] for r in got.collect()}[None] == "lone"
    small = ordered_concat(data, ["k"], F.col("text"), [F.col("n")], ";")
    assert small.count() == 52
    assert {r["k"]: r["definition"] for r in small.collect()}[-1] == want


def test_cells_of_mixed_rows_keep_their_bound(spark):
    """One key of many small rows beside one of few large ones: no cell exceeds the bound."""
    data = spark.range(5000).selectExpr("'small' as k", "id as n", "'x' as text")
    data = data.unionByName(spark.range(20).selectExpr("'large' as k", "id as n", "repeat('y', 500) as text"))
    got = ordered_concat(data, ["k"], F.col("text"), [F.col("n")], max_cell_bytes=1000, head=F.col("k")).collect()
    assert max(len(r["definition"]) - len(r["k"]) * (r["part_no"] == 0) for r in got) <= 1000
    for k, whole in (("small", "small" + "x" * 5000), ("large", "large" + "y" * 10000)):
        assert "".join(r["definition"] for r in sorted(got, key=lambda r: r["part_no"]) if r["k"] == k) == whole


def test_building_starts_no_job(spark):
    data = spark.range(100).selectExpr("id % 3 as k", "id as n", "'x' as text")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    ordered_concat(data, ["k"], F.col("text"), [F.col("n")])
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_grant_statements(table):
    principals = table(
        [
            (1, 2, "sqluser", "S", "0x01", "shop", "us", 1),
            (1, 3, "DOM\\win", "U", None, "shop", "us", 0),
            (1, 4, "##sys", "S", "0x02", "shop", "us", 0),
            (1, 9, "sysadmin", "R", None, None, None, 0),
        ],
        "dbserver_id int, principal_id int, name string, type string, password_hash string, "
        "default_database_name string, default_language_name string, is_disabled int",
    )
    role_members = table(
        [(1, 9, 2)], "dbserver_id int, role_principal_id int, member_principal_id int"
    )
    permissions = table(
        [(1, 2, "CONNECT SQL"), (1, 2, "VIEW ANY"), (1, 4, "VIEW ANY"), (1, 9, "VIEW ANY")],
        "dbserver_id int, grantee_principal_id int, permission_name string",
    )
    db = "dbserver_id int, database_name string, grantee_principal_id int, grantee_name string, " \
        "grantee_type_desc string, permission_name string, class_desc string, state_desc string, " \
        "object_name string"
    db_permissions = table(
        [
            (1, "shop", 5, "u", "SQL_USER", "CONNECT", "DATABASE", "GRANT", None),
            (1, "shop", 5, "u", "SQL_USER", "CREATE", "DATABASE", "DENY", None),
            (1, "shop", 5, "u", "SQL_USER", "SELECT", "OBJECT", "GRANT", "t"),
            (1, "tempDB", 5, "u", "SQL_USER", "SELECT", "OBJECT", "GRANT", "t"),
            (1, "shop", 1, "dbo", "SQL_USER", "CONNECT", "DATABASE", "GRANT", None),
            (1, "shop", 6, "r", "DATABASE_ROLE", "CONNECT", "DATABASE", "GRANT", None),
        ],
        db,
    )
    members = table(
        [(1, "shop", 5, "u", "db_owner"), (1, "shop", 1, "dbo", "db_owner"), (1, "msdb", 5, "u", "x")],
        "dbserver_id int, database_name string, member_uid int, member_name string, group_name string",
    )
    got = col.grant_statements(principals, role_members, permissions, db_permissions, members)
    assert rows(got, "name", "step", "statement") == sorted(
        [
            ("sqluser", "1login", "CREATE LOGIN [sqluser] WITH PASSWORD=0x01 HASHED,DEFAULT_DATABASE=[shop], "
             "DEFAULT_LANGUAGE=[us];  ALTER LOGIN [sqluser] DISABLED;"),
            ("DOM\\win", "1login", "CREATE LOGIN [DOM\\win] FROM WINDOWS;"),
            ("sqluser", "2role", "EXEC sp_addsrvrolemember 'sqluser','sysadmin';"),
            ("sqluser", "3priv", "GRANT VIEW ANY TO [sqluser];"),
            ("u", "4dbpriv-shop-CONNECT", "USE [shop]; CREATE USER [u];"),
            ("u", "4dbpriv-shop-CREATE", "DENY CREATE TO [u];"),
            ("u", "4dbpriv-shop-SELECT", "GRANT SELECT ON t TO [u];"),
            ("u", "5dbrole-shop", "USE [shop]; EXEC sp_addrolemember 'db_owner','u';"),
        ]
    )
    joined = dict(rows(col.grants_ordered_concat(got), "account", "definition"))
    assert joined["u@%"].startswith("USE [shop]; CREATE USER [u]; DENY CREATE TO [u]; GRANT")
    assert rows(col.login_list(principals), "user_name", "user_host", "password") == [
        ("DOM\\win", "%", None), ("sqluser", "%", "0x01"),
    ]


def test_backups(table):
    listing = table(
        [(1, "/b/full-20240131-235959.gz", 5), (1, "/b/other.gz", 6), (1, "/b/20241399-000000.gz", 7)],
        "dbserver_id int, path string, length bigint",
    ).withColumn("modified", F.lit("2024-02-01 00:10:00").cast("timestamp"))
    got = [(r["file"], str(r["start"])) for r in col.backup_files(listing).orderBy("size").collect()]
    assert got == [
        ("/b/full-20240131-235959.gz", "2024-01-31 23:59:59"), ("/b/other.gz", "None"),
        ("/b/20241399-000000.gz", "None"),
    ]
    logs = table(
        [
            (1, "/b/x-backup.log", 1, "start"), (1, "/b/x-backup.log", 2, "innobackup: completed OK!"),
            (1, "/b/x-backup.log", 3, "bye"), (1, "/c/y-backup.log", 2, "failed"),
            (1, "/c/y-backup.log", 1, "start"),
        ],
        "dbserver_id int, log string, line_no int, line string",
    )
    files = table([(1, "/b/1.gz"), (1, "/b/2.gz")], "dbserver_id int, path string")
    status = col.backup_status(logs, files)
    assert rows(status) == [
        (1, "/b/x-backup.log", "COMPLETE", "/b/2.gz"), (1, "/c/y-backup.log", "failed", None),
    ]
    stored = table(
        [(1, "/b/2.gz", None), (1, "/b/1.gz", "old")], "dbserver_id int, file string, status string"
    )
    assert rows(col.apply_backup_status(stored, status), "file", "status") == [
        ("/b/1.gz", "old"), ("/b/2.gz", "COMPLETE"),
    ]
