import datetime as dt

from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators import collect as col
from fleetwarden.operators import health as hl
from fleetwarden.sources import readers, sinks
from tests.conftest import rows


def test_tsv(spark, tmp_path):
    path = tmp_path / "objects.tsv"
    path.write_text(
        '1\tshop\ttable\ta"b\tline1\\nline2\\tx\\\\n\n'
        "2\tshop\tview\t\\N\t\n"
        "x\tshop\tview\tNULL\n"
    )
    got = readers.read_tsv(spark, str(path), schemas.STAGED_OBJECTS, run_id="r1")
    assert rows(got) == [
        (None, "shop", "view", "NULL", None, "r1"),
        (1, "shop", "table", 'a"b', "line1\nline2\tx\\n", "r1"),
        (2, "shop", "view", None, "", "r1"),
    ]
    plain = readers.read_tsv(spark, str(path), schemas.STAGED_OBJECTS, escapes=False)
    assert dict(rows(plain, "dbserver_id", "definition"))[1] == "line1\\nline2\\tx\\\\n"
    assert dict(rows(plain, "dbserver_id", "name"))[2] == "\\N"


def test_short_account_rows_have_no_definition(spark, tmp_path):
    path = tmp_path / "accounts.tsv"
    path.write_text("1\tann\t%\t0xAB\t0\n")
    got = readers.read_tsv(spark, str(path), schemas.STAGED_ACCOUNTS)
    assert rows(got) == [(1, "ann", "%", "0xAB", 0, None)]


def test_log_lines_keep_their_order_over_splits(spark, tmp_path):
    for name, n in (("a-backup.log", 4000), ("b-backup.log", 10)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(n)) + f"{name} end\n")
    (tmp_path / "other.txt").write_text("no\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = readers.read_lines(spark, str(tmp_path), "*backup*.log")
        assert lines.rdd.getNumPartitions() > 4
        logs = lines.select(F.lit(1).alias("dbserver_id"), F.col("file").alias("log"), "line_no", "line")
        files = spark.createDataFrame([], "dbserver_id int, path string")
        got = rows(col.backup_status(logs, files), "status")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("a-backup.log end",), ("b-backup.log end",)]


def test_status_records(spark, tmp_path):
    record = "  Master_Host: h{0}\n Seconds_Behind_Master: {0}\n Last_Error: \n Last_Error: a: b\n Gap: NULL\n"
    (tmp_path / "s.txt").write_text(
        "".join(f"{readers.RECORD_MARK}{i}. row {'*' * 27}\n" + record.format(i) for i in range(1, 4))
    )
    got = readers.read_records(spark, str(tmp_path / "s.txt"))
    fields = sorted((r["fields"] for r in got.collect()), key=lambda f: f["Master_Host"])
    assert len(fields) == 3
    assert fields[1] == {
        "Master_Host": "h2", "Seconds_Behind_Master": "2", "Last_Error": "a: b", "Gap": None,
    }
    # A server without replication prints nothing: no record, hence no state.
    (tmp_path / "empty.txt").write_text("")
    assert readers.read_records(spark, str(tmp_path / "empty.txt")).count() == 0


def test_report_and_patterns(spark, tmp_path):
    (tmp_path / "r.txt").write_text("status,warning,x\n2,0,s,p,d,6,7,8,5,10,11,12,13,14,t,a\n")
    got = hl.replication_subscriptions(readers.read_report(spark, str(tmp_path / "r.txt")))
    assert rows(got, "publisher_db", "state") == [("d", "ok")]
    (tmp_path / "p.log").write_text("abc\n\n[x]\n")
    assert rows(readers.read_patterns(spark, str(tmp_path / "p.log"))) == [("[x]",), ("abc",)]


def test_listing(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "full-20240131-101112.tar.gz").write_bytes(b"12345")
    (tmp_path / "d" / "x.log").write_text("no")
    got = readers.read_listing(spark, str(tmp_path), "*.*gz")
    files = col.backup_files(got.withColumn("dbserver_id", F.lit(1)))
    row = files.collect()[0]
    assert (row["file"], row["size"]) == (f"{tmp_path}/d/full-20240131-101112.tar.gz", 5)
    assert row["start"] == dt.datetime(2024, 1, 31, 10, 11, 12)
    assert "content" not in got.columns
    assert readers.read_listing(spark, str(tmp_path), "*.*gz", "2999-01-01T00:00:00").count() == 0


def test_sheet_and_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Timestamp,Username,Region\r\n1/1,"ann, b",sg\r\n,,\r\n')
    sheet = readers.read_sheet(spark, str(tmp_path / "s.csv"), ["stamp", "user", "region"])
    assert rows(sheet)[-1] == ("1/1", "ann, b", "sg")
    sinks.write_csv(sheet.filter("user is not null"), str(tmp_path / "out"), by="region")
    assert (tmp_path / "out" / "region=sg").is_dir()
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert rows(back, "stamp", "user", "region") == [("1/1", "ann, b", "sg")]


def test_state_versions(spark, tmp_path):
    base = str(tmp_path / "state")
    sinks.write_state(spark.range(3), base, 1)
    sinks.write_state(sinks.read_state(spark, base, 1).filter("id > 0"), base, 2)
    assert sinks.read_state(spark, base, 1).count() == 3
    assert sinks.read_state(spark, base, 2).count() == 2


def test_catalog_columns(spark, table):
    table([(1, "a")], "uid bigint, username string").createOrReplaceTempView("catalog_probe")
    assert rows(readers.catalog_columns(spark, "catalog_probe")) == [
        ("uid", "bigint"), ("username", "string"),
    ]


def test_packed_files_read_like_files(spark, table, tmp_path):
    """Captured files packed into a few give what the files give, and no file per captured file."""
    mark = readers.RECORD_MARK
    captured = [(f"dbserver_id={i}/f.txt", text) for i in range(60) for text in (f"a{i}\nb\r", "", None, f"{mark}1. row\n K: {i}\n\tL: x")]
    for file, text in captured:
        (tmp_path / "plain" / file).parent.mkdir(parents=True, exist_ok=True)
        with (tmp_path / "plain" / file).open("a", newline="") as out:
            out.write((text or "") + "\n")
    packed = sinks.write_packed(table(captured, "file string, value string").coalesce(3), str(tmp_path / "few"))
    assert len(list((tmp_path / "few.packed").glob("part-*"))) <= 3
    plain = str(tmp_path / "plain")
    server = F.regexp_extract("file", r"dbserver_id=(\d+)", 1).cast("int").alias("server")

    def both(read, *columns):
        return [rows(read(spark, path), *columns) for path in (plain, packed)]

    for read, columns in ((readers.read_lines, [server, "line"]), (readers.read_report, [server, "line"]),
                          (readers.read_records, [server, F.to_json("fields")])):
        wanted, got = both(read, *columns)
        assert got == wanted and len(got) >= 60
    path = F.regexp_extract("path", "dbserver_id=.*", 0)
    wanted, got = both(readers.read_listing, path, "length")
    assert got == wanted and len(got) == 60
    assert readers.read_listing(spark, packed, "*.log").count() == 0
    assert readers.read_lines(spark, packed, "f.?xt").count() == readers.read_lines(spark, packed).count()
    order = readers.read_lines(spark, packed).filter(server == 7).orderBy("line_no").select("line").collect()
    assert [r["line"] for r in order][:4] == ["a7", "b", "", ""]
