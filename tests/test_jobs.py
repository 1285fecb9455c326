import datetime as dt

from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators.requests import churn_batch
from fleetwarden.plans import jobs
from fleetwarden.sources import sinks
from tests.conftest import rows
from tests.test_inventory import fleet

RUN = "2024-02-01T00:00"


def test_delete_scope(table):
    servers, *_ = fleet(table)

    def ids(*args, **site):
        return [r[0] for r in rows(jobs.delete_scope(servers, *args, **site))]

    assert ids("sessions", ["MySQL", "MariaDB"]) == [1, 2, 3, 5, 6, 7, 8]
    assert ids("objects", ["MySQL"], game_id="H", location="VN") == [7]
    assert ids("objects", ["MySQL"], game_id="G", location="SG", ip="10.0.0.7") == [1, 2, 7]
    assert ids("accounts", ["MSSQL"]) == [4]


def test_sessions(spark, table, tmp_path):
    servers, *_ = fleet(table)
    base = str(tmp_path / "state")
    old = [(1, "ann", "h", 5, "r0", None), (2, "ann", "h", 5, "r0", None), (4, "sa", "h", 1, "r0", None)]
    sinks.write_state(table(old, schemas.SESSIONS), base, 0)
    path = tmp_path / "sessions.tsv"
    path.write_text("1\tann\th\t7\n1\tann\th\t99\n1\tbo\tk\t2\n")
    outcomes = table([(2, RUN, False)], schemas.COLLECTION_OUTCOME)
    got = jobs.collect_sessions(
        spark, str(path), base, 0, RUN, servers, "2024-02-01 00:00:00", outcomes, game_id="G", location="SG"
    )
    assert rows(got, "dbserver_id", "user_name", "session_count", "run_id") == [
        (1, "ann", 7, RUN), (1, "bo", 2, RUN), (2, "ann", 5, "r0"), (4, "sa", 1, "r0"),
    ]
    assert dict(rows(got, "user_name", "creation_date"))["bo"] == dt.datetime(2024, 2, 1)


def test_accounts(spark, table, tmp_path):
    servers, *_ = fleet(table)
    base = str(tmp_path / "state")
    stored = table([(1, "gone", "%", 0, None, 0, "x", "r0"), (4, "sa", "%", 0, None, 0, "x", "r0")], schemas.ACCOUNTS)
    sinks.write_state(stored, base, 0)
    (tmp_path / "accounts.tsv").write_text("1\tann\t%\tNULL\t0\n1\tbo\th\t0xAB\t3\n")
    (tmp_path / "grants").mkdir()
    (tmp_path / "grants" / "server-1.txt").write_text(
        "*** 1. row ***\nGrants for ann@%: GRANT USAGE ON *.*\n*** 2. row ***\nGrants for ann@%: GRANT A\n"
    )
    grants = jobs.read_grants(
        spark, str(tmp_path / "grants"), F.regexp_extract("file", r"server-(\d+)", 1)
    )
    accounts = jobs.read_accounts(spark, str(tmp_path / "accounts.tsv"))
    got = jobs.collect_accounts(accounts, grants, base, 0, RUN, servers)
    assert rows(got, "dbserver_id", "user_name", "password", "definition") == [
        (1, "ann", None, "GRANT USAGE ON *.*;\nGRANT A;\n"), (1, "bo", "0xAB", None), (4, "sa", None, "x"),
    ]


def test_objects(spark, table, tmp_path):
    servers, *_ = fleet(table)
    base = str(tmp_path / "state")
    sinks.write_state(table([], schemas.OBJECTS), base, 0)
    (tmp_path / "o.tsv").write_text("1\tshop\ttable\tt\tCREATE TABLE t (\\n) AUTO_INCREMENT=5 x\n")
    got = jobs.collect_objects(spark, str(tmp_path / "o.tsv"), base, 0, RUN, servers)
    assert rows(got, "name", "definition", "run_id") == [("t", "CREATE TABLE t (\n) x", RUN)]


def test_captured_and_built_objects(spark, table, tmp_path):
    servers, *_ = fleet(table)
    base = str(tmp_path / "state")
    sinks.write_state(table([], schemas.OBJECTS), base, 0)
    for kind, line in (("table", "shop\tt\tCREATE TABLE t AUTO_INCREMENT=9\n"), ("event", "shop\te\tx\tUTC\tCREATE EVENT e\n")):
        folder = tmp_path / kind / "dbserver_id=1"
        folder.mkdir(parents=True)
        (folder / "f.tsv").write_text(line)
    paths = {k: str(tmp_path / k) for k in ("table", "event")}
    first = jobs.collect_captured_objects(spark, paths, base, 0, RUN, servers)
    assert rows(first, "dbserver_id", "dbschema", "type", "name", "definition") == [
        (1, "shop", "event", "e", "CREATE EVENT e"), (1, "shop", "table", "t", "CREATE TABLE t"),
    ]
    columns = table([(4, "db", "u", 1, "id", 56, 4), (4, "db", "u", 2, "v", 56, 8)],
                    "dbserver_id int, dbschema string, object string, column_id int, name string, user_type_id int, max_length int")
    types = table([(56, "int")], "user_type_id int, name string")
    keys = table([(4, "db", "u", 1)], "dbserver_id int, dbschema string, object string, column_id int")
    second = jobs.collect_built_objects(columns, types, keys, base, 1, RUN, servers)
    assert rows(second, "dbserver_id", "name", "part_no") == [(1, "e", 0), (1, "t", 0), (4, "u", 0)]
    assert "id int(4) Primary Key" in dict(rows(second, "name", "definition"))["u"]


def test_old_versions_are_retired(spark, table, tmp_path):
    base = str(tmp_path / "state")
    for version in range(4):
        sinks.write_state(table([(version,)], "n int"), base, version)
    assert sinks.stored_versions(spark, base) == [0, 1, 2, 3]
    assert sinks.retire_versions(spark, base, [0, 2, 3, 9]) == [0, 2]
    assert sinks.stored_versions(spark, base) == [1, 3] and rows(sinks.read_state(spark, base, 3)) == [(3,)]
    assert sinks.stored_versions(spark, str(tmp_path / "none")) == []


def test_backups(spark, table, tmp_path):
    servers, *_ = fleet(table)
    base = str(tmp_path / "state")
    stored = [(2, "/b/old.gz", 1, None, None, "COMPLETE", "r0"), (2, "/b/1.gz", 1, None, None, None, "r0"),
              (7, "/b/other.gz", 1, None, None, "COMPLETE", "r0")]
    sinks.write_state(table(stored, schemas.BACKUPS), base, 0)
    listing = table([(2, "/b/1.gz", 9), (2, "/b/2.gz", 8)], "dbserver_id int, path string, length bigint")
    listing = listing.withColumn("modified", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    logs = table([(2, "/b/x-backup.log", 1, "failed: disk")],
                 "dbserver_id int, log string, line_no int, line string")
    got = jobs.collect_backups(listing, logs, base, 0, RUN, servers)
    assert rows(got, "file", "size", "status") == [
        ("/b/1.gz", 9, None), ("/b/2.gz", 8, "failed: disk"), ("/b/other.gz", 1, "COMPLETE"),
    ]


def test_reports_are_written_by_owner(spark, table, tmp_path):
    from tests.test_reports import dictionary

    objects, entries = dictionary(table)
    jobs.publish_dictionary(objects, entries, str(tmp_path / "dict"))
    assert (tmp_path / "dict" / "dbserver_id=1" / "dbschema=s").is_dir()
    alerts = table([(7, "f", "broken")], "contact_id int, file string, failure_reason string")
    jobs.publish_alerts(alerts, str(tmp_path / "alerts"))
    assert spark.read.text(str(tmp_path / "alerts" / "contact_id=7")).count() == 1


def test_requests_are_answered_once(table, tmp_path):
    base = str(tmp_path)
    schema = "request_id int, region string, days_from int, days_to int, level_from int, level_to int"
    sheet = [(1, "sg", 1, 5, 1, 9), (2, "sg", 1, 5, 1, 9)]
    sinks.append_rows(table(sheet[:1], schema), f"{base}/ledger", 0)
    users = table([(5, 1706572800 - 86400, 3, "sg")], schemas.USER_ACTIVITY + ", region string")
    run = lambda pending: churn_batch(users, pending, "2024-01-31")
    first = jobs.run_pending(table(sheet, schema), base, 0, run)
    assert rows(first, "request_id", "uid") == [(2, 5)]
    # The same run again gives the same answers, the next one has nothing left to do.
    assert rows(jobs.run_pending(table(sheet, schema), base, 0, run), "request_id") == [(2,)]
    assert jobs.run_pending(table(sheet, schema), base, 1, run).count() == 0


def test_codes_are_issued_within_the_quota(spark, table, tmp_path):
    base = str(tmp_path)
    sinks.append_rows(table([], schemas.CODES), f"{base}/codes", 0)
    schema = "request_id int, batch_id string, amount int"
    batches = table([("a",), ("b",)], "id string")
    sheet = [(1, "b", 150000), (2, "b", 60000), (3, "b", 50000), (4, "a", 10), (5, "c", 1), (6, "b", 1), (7, None, 1)]
    first = jobs.issue_codes(table(sheet, schema), batches, base, 0, "s", "2024-02-01")
    assert rows(first, "request_id", "existing", "accepted") == [
        (1, 0, True), (2, 150000, False), (3, 150000, True), (4, 0, True), (5, 0, False), (6, 200000, False), (7, 0, False),
    ]
    # The same request numbers again, in another run: other codes, and again as many as wanted.
    second = jobs.issue_codes(table([(4, "a", 100)], schema), batches, base, 1, "s", "2024-02-02")
    assert rows(second, "request_id", "existing", "accepted") == [(4, 10, True)]
    codes = sinks.read_appended(spark, f"{base}/codes", 2)
    assert codes.count() == 200110 == codes.select("id").distinct().count()


def test_active_servers_only_lose_what_is_collected(spark, table, tmp_path):
    """A server with active = 2 is not collected for accounts, so its accounts stay."""
    servers, *_ = fleet(table)
    servers = servers.withColumn("active", F.when(F.col("id") == 1, 2).otherwise(F.col("active")))
    base = str(tmp_path / "state")
    sinks.write_state(table([(1, "ann", "%", 0, None, 0, "x", "r0"), (2, "bo", "%", 0, None, 0, "x", "r0")], schemas.ACCOUNTS), base, 0)
    (tmp_path / "accounts.tsv").write_text("2\tcy\t%\tNULL\t0\n\\N\tlost\t%\tNULL\t0\n")
    grants = table([], "dbserver_id int, account string, part_no bigint, definition string")
    accounts = jobs.read_accounts(spark, str(tmp_path / "accounts.tsv"))
    got = jobs.collect_accounts(accounts, grants, base, 0, RUN, servers)
    assert rows(got, "dbserver_id", "user_name") == [(1, "ann"), (2, "cy")]
    # What has no key cannot be stored; it is kept beside the state.
    assert rows(sinks.read_state(spark, f"{base}-rejected", 1), "user_name") == [("lost",)]
