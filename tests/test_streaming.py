from types import SimpleNamespace

from pyspark.sql import functions as F

from fleetwarden.functions.times import log_time
from fleetwarden.operators.requests import pending_requests
from fleetwarden.plans import streams as plans
from fleetwarden.session import scratch_dir
from fleetwarden.sources import buckets as bk
from fleetwarden.streaming import streams
from tests.conftest import rows


def run(writer, folder):
    query = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")


def put(df, folder):
    df.coalesce(1).write.mode("append").json(f"{folder}/in")


def test_log_time(table):
    lines = table(
        [("240301  9:01:02 x",), ("240301 10:01:02 x",), ("2024-03-01 09:00:01 x",), ("2024-03-01T09:00:01.5Z",),
         ("at x",), ("241399 10:01:02",)],
        "line string",
    )
    got = [str(r[0]) for r in lines.select(log_time(F.col("line"))).collect()]
    assert got == [
        "2024-03-01 09:01:02", "2024-03-01 10:01:02", "2024-03-01 09:00:01", "2024-03-01 09:00:01", "None",
        "None",
    ]


def test_log_errors_stream(spark, table, tmp_path):
    folder, schema = str(tmp_path), "dbserver_id int, line string"
    put(table([(1, "2024-03-01 09:01:00 boom"), (1, "240301  9:02:00 boom"), (1, "2024-03-01 09:03:00 [Note] Coordinator"),
               (2, "2024-03-01 09:59:59 boom"), (1, "  at trace")], schema), folder)
    put(table([(1, "2024-03-01 12:00:00 boom")], schema), folder)
    # A row is late against the watermark of the batch before its own.
    put(table([(1, "2024-03-01 12:01:00 boom")], schema), folder)
    put(table([(1, "2024-03-01 09:05:00 far too late"), (1, "2024-03-01 12:30:00 boom")], schema), folder)
    counts = streams.stream_log_errors(source(spark, folder, schema))
    run(counts.writeStream.format("parquet").option("path", f"{folder}/out"), folder)
    got = spark.read.schema(counts.schema).parquet(f"{folder}/out")
    found = [(s, str(w), n) for s, w, n in rows(got, "dbserver_id", "window_start", "error_lines")]
    assert found == [(1, "2024-03-01 09:00:00", 2), (2, "2024-03-01 09:00:00", 1)]


def test_snapshot_stream_waits_for_the_end_of_a_run(spark, table, tmp_path):
    folder = str(tmp_path)
    schema = "dbserver_id int, user_name string, n int, line int, run_id string, complete boolean"
    initial = table([(1, "old", 5, "r0"), (2, "old", 6, "r0"), (3, "old", 7, "r0")],
                    "dbserver_id int, user_name string, n int, run_id string")

    def batch(*found):
        put(table(list(found), schema), folder)
        staged = source(spark, folder, schema)
        run(streams.stream_snapshot(staged, f"{folder}/state", initial, ["dbserver_id", "user_name"], ["n"], ["line"]), folder)

    def state(n):
        return rows(streams.snapshot_state(spark, f"{folder}/state", n))

    start = [(1, "old", 5, "r0"), (2, "old", 6, "r0"), (3, "old", 7, "r0")]
    # One collection of server 1 in two batches; nothing changes before it has ended.
    batch((1, "a", 1, 1, "r1", None), (1, "a", 9, 2, "r1", False))
    assert state(1) == start
    batch((1, "b", 2, 3, "r1", None), (1, None, None, None, "r1", True), (2, "x", 1, 1, "r1", None))
    both = [(1, "a", 1, "r1"), (1, "b", 2, "r1"), (2, "old", 6, "r0"), (3, "old", 7, "r0")]
    assert state(2) == both
    # A run without rows clears its server; the unfinished run of server 2 ends later.
    batch((3, None, None, None, "r2", True), (1, "b", 4, 1, "r2", None), (2, "y", 2, 1, "r1", None))
    assert state(3) == both[:3]
    batch((2, None, None, None, "r1", True), (1, None, None, None, "r2", True))
    assert state(4) == [(1, "b", 4, "r2"), (2, "x", 1, "r1"), (2, "y", 2, "r1")]
    # Only the servers that ended are written.
    assert spark.read.parquet(f"{folder}/state/state").filter("version = 3").count() == 0
    assert state(2) == both


SNAPSHOT = "dbserver_id int, user_name string, n int, line int, run_id string, complete boolean"


def merge_of(spark, base, initial):
    """The function that the stream calls for each micro-batch."""
    taken = {}

    class Writer:
        def foreachBatch(self, merge):
            taken["merge"] = merge

    streams.stream_snapshot(SimpleNamespace(writeStream=Writer()), base, initial, ["dbserver_id", "user_name"], ["n"], ["line"])
    return taken["merge"]


def test_snapshot_stream_reads_as_much_however_long_it_has_run(spark, table, tmp_path, monkeypatch):
    base = str(tmp_path / "state")
    initial = table([(i, "old", i, "r0") for i in range(40)], "dbserver_id int, user_name string, n int, run_id string")
    merge = merge_of(spark, base, initial)
    listed = []
    real = bk.read_buckets

    def counting(spark, folder, manifest, name, buckets, schema):
        buckets = list(buckets)
        listed[-1] += sum(len(manifest.get(b, {}).get(name, ())) for b in buckets)
        return real(spark, folder, manifest, name, buckets, schema)

    monkeypatch.setattr(bk, "read_buckets", counting)
    for k in range(10):
        listed.append(0)
        run = f"r{k + 1:02d}"
        batch = [(1, "a", k, 1, run, None), (2, "b", k, 1, run, None), (7, "late", k, 1, "r99", None), (1, None, None, None, run, True)]
        merge(table(batch, SNAPSHOT), k)
    # Server 7 never ends: its rows wait, in a bucket that no batch reads.
    assert listed[0] <= max(listed[1:]) and max(listed[2:]) == listed[2] and listed[9] <= listed[2]
    got = {r[0]: tuple(r)[1:] for r in rows_of(streams.snapshot_state(spark, base, 10))}
    assert got[1] == ("a", 9, "r10") and got[2] == ("old", 2, "r0") and got[7] == ("old", 7, "r0") and len(got) == 40
    merge(table([(7, None, None, None, "r99", True)], SNAPSHOT), 10)
    assert {tuple(r) for r in rows_of(streams.snapshot_state(spark, base, 11).filter("dbserver_id = 7"))} == {(7, "late", 0, "r99")}


def rows_of(df):
    return df.select("dbserver_id", "user_name", "n", "run_id").collect()


def test_snapshot_batches_run_again_change_nothing(spark, table, tmp_path):
    base = str(tmp_path / "state")
    initial = table([(1, "old", 5, "r0"), (2, "old", 6, "r0")], "dbserver_id int, user_name string, n int, run_id string")
    merge = merge_of(spark, base, initial)
    batches = [
        [(1, "a", 1, 1, "r1", None), (2, "x", 1, 1, "r1", None)],
        [(1, "b", 2, 2, "r1", None), (1, None, None, None, "r1", True)],
        [(2, None, None, None, "r1", True), (1, "c", 3, 1, "r2", None)],
        [(1, None, None, None, "r1", True), (1, None, None, None, "r0", True)],
    ]
    want = [
        {(1, "old", 5, "r0"), (2, "old", 6, "r0")},
        {(1, "a", 1, "r1"), (1, "b", 2, "r1"), (2, "old", 6, "r0")},
        {(1, "a", 1, "r1"), (1, "b", 2, "r1"), (2, "x", 1, "r1")},
        {(1, "a", 1, "r1"), (1, "b", 2, "r1"), (2, "x", 1, "r1")},  # an end told twice, and one long past
    ]
    for k, batch in enumerate(batches):
        for _ in range(2):
            merge(table(batch, SNAPSHOT), k)
            assert {tuple(r) for r in rows_of(streams.snapshot_state(spark, base, k + 1))} == want[k]
    assert {tuple(r) for r in rows_of(streams.snapshot_state(spark, base, 2))} == want[1]


def test_snapshot_stream_from_nothing(spark, table, tmp_path):
    base = str(tmp_path / "state")
    initial = table([], "dbserver_id int, user_name string, n int, run_id string")
    merge = merge_of(spark, base, initial)
    merge(table([], SNAPSHOT), 0)
    assert rows_of(streams.snapshot_state(spark, base, 1)) == []
    merge(table([(1, "a", 1, 1, "r1", None), (1, None, None, None, "r1", True)], SNAPSHOT), 1)
    assert [tuple(r) for r in rows_of(streams.snapshot_state(spark, base, 2))] == [(1, "a", 1, "r1")]


def test_snapshot_query_keeps_the_partitions_of_its_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "scratch_dir", lambda *_: str(tmp_path))
    read = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("events", "customer")}
    t = SimpleNamespace(spark=spark, events=read["events"].repartition(4), customer=read["customer"])
    assert plans.stream_snapshot(t).count() > 0
    assert len(list((tmp_path / "in").glob("*.parquet"))) >= 12
    assert {p.name for p in (tmp_path / "checkpoint" / "commits").glob("[0-9]*")} == {"0", "1", "2"}


def test_requests_stream_runs_each_once(spark, table, tmp_path):
    folder, schema = str(tmp_path), "stamp string, user string"
    ledger = table([("1", "done")], schema)
    put(table([("1", "done"), ("1", "ann")], schema), folder)
    sheet = source(spark, folder, schema)

    def write():
        return streams.stream_requests(
            sheet, f"{folder}/work", ledger, lambda p: p.withColumn("answer", F.upper("user"))
        )

    run(write(), folder)
    put(table([("1", "ann"), ("2", "ann"), ("2", "ann")], schema), folder)
    run(write(), folder)
    got = spark.read.parquet(f"{folder}/work/result")
    assert rows(got, "stamp", "user", "answer", "version") == [("1", "ann", "ANN", 1), ("2", "ann", "ANN", 2)]
    done = spark.read.parquet(f"{folder}/work/ledger").drop("version")
    assert pending_requests(table([("1", "ann"), ("2", "ann"), ("1", "done")], schema), done).count() == 0


def test_scratch_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(base) and one != two
