"""Queries of the streaming forms: a table is read as a stream to its end, the result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.operators.requests import churn_batch
from fleetwarden.plans.registry import query
from fleetwarden.plans.requests import AS_OF, LOW_DAY
from fleetwarden.plans.snapshots import SESSION_KEYS
from fleetwarden.session import scratch_dir
from fleetwarden.streaming import streams


def _stream(t, name: str) -> DataFrame:
    """A given table as a stream; the path is a pattern, as the source takes no single file."""
    path = f"{t.sf_dir}/{name[:-1]}[{name[-1]}].parquet"
    return t.spark.readStream.schema(t[name].schema).parquet(path)


def _run(writer, folder: str) -> int:
    """Run to the end of the input; the number of the last batch."""
    running = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    batches = [p["batchId"] for p in running.recentProgress]
    return max(batches)


@query(
    """
    with e as (select cast(user_id as int) as dbserver_id, event_type,
        date_trunc('second', ts) as stamp from events),
    w as (select dbserver_id, date_trunc('hour', stamp) as window_start, count(*) as error_lines from e
      where event_type <> 'view' group by 1, 2)
    select * from w where window_start + interval 1 hour <=
      (select max(stamp) - interval 10 minute from e where event_type <> 'view')"""
)
def stream_log_errors(t):
    """Windows closed by the watermark; the batch form's counts over the same windows."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    old = F.date_format("ts", "yyMMdd HH:mm:ss")
    line = F.concat(
        F.when(F.col("event_type") == "error", old).otherwise(stamp),
        F.lit(" ["), "event_type", F.lit("]"),
    )
    lines = _stream(t, "events").select(
        F.col("user_id").cast("int").alias("dbserver_id"), line.alias("line")
    )
    folder = scratch_dir(t.spark, "stream-log-errors")
    counts = streams.stream_log_errors(lines, ["[view]"])
    _run(counts.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out"), folder)
    return t.spark.read.schema(counts.schema).parquet(f"{folder}/out")


@query(
    """
    with s as (select dbserver_id, user_name, user_host, max(session_count) as session_count from (
        select cast(user_id as int) as dbserver_id, event_type as user_name, 'any' as user_host,
          cast(floor(value * 100) as bigint) as session_count from events where user_id % 5 <> 0)
        group by 1, 2, 3),
    c as (select distinct cast(c_custkey as int) as dbserver_id, 'view' as user_name, 'any' as user_host
      from customer)
    select coalesce(c.dbserver_id, s.dbserver_id) as dbserver_id,
      coalesce(c.user_name, s.user_name) as user_name, coalesce(c.user_host, s.user_host) as user_host,
      case when s.dbserver_id is null then 0 else s.session_count end as session_count,
      case when s.dbserver_id is null then 'none' else 'run-1' end as run_id
    from c full outer join s on c.dbserver_id = s.dbserver_id and c.user_name = s.user_name
      and c.user_host = s.user_host
    where s.dbserver_id is not null or c.dbserver_id not in (select dbserver_id from s)"""
)
def stream_snapshot(t):
    """Sessions of one run in several batches; the servers that 5 divides never finish."""
    folder = scratch_dir(t.spark, "stream-snapshot")
    rows = t.events.select(
        F.col("user_id").cast("int").alias("dbserver_id"),
        F.col("event_type").alias("user_name"),
        F.lit("any").alias("user_host"),
        F.floor(F.col("value") * 100).cast("bigint").alias("session_count"),
        F.lit("run-1").alias("run_id"),
        F.lit(False).alias("complete"),
    ).withColumn("_rank", -F.col("session_count"))
    marks = rows.filter("dbserver_id % 5 <> 0").select("dbserver_id", "run_id", F.lit(True).alias("complete")).distinct()
    staged = rows.unionByName(marks, allowMissingColumns=True)
    # Three parts of any number of files, and the marks in the last of them. The stream goes on to the end
    # after each: one micro-batch.
    part = F.when(F.col("complete"), 2).otherwise(F.pmod(F.col("session_count"), F.lit(3)))
    initial = t.customer.select(
        F.col("c_custkey").cast("int").alias("dbserver_id"), F.lit("view").alias("user_name"),
        F.lit("any").alias("user_host"), F.lit(0).cast("bigint").alias("session_count"),
        F.lit("none").alias("run_id"),
    )
    for k in range(3):
        staged.filter(part == k).write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(staged.schema).parquet(f"{folder}/in")
        writer = streams.stream_snapshot(stream, f"{folder}/state", initial, SESSION_KEYS, ["session_count"], ["_rank"])
        batch = _run(writer, folder)
    return streams.snapshot_state(t.spark, f"{folder}/state", batch + 1)


@query(
    f"""
    select r.n_nationkey as request_id, u.uid, epoch_ms(u.last_active_time * 1000) as last_login_datetime,
      u.level
    from user_activity u join nation r on u.region = r.n_regionkey
      and u.last_active_time >= ({LOW_DAY} - (r.n_nationkey * 4 + 31)) * 86400
      and u.last_active_time < ({LOW_DAY} - r.n_nationkey * 4) * 86400
      and u.level between 1 and 25
    where r.n_regionkey <> 2""",
    "user_activity",
)
def stream_requests(t):
    """New rows of a request sheet run once as cohort requests; the ledger holds one region's."""
    folder = scratch_dir(t.spark, "stream-requests")
    sheet = _stream(t, "nation")
    done = t.nation.filter("n_regionkey = 2")

    def run(pending: DataFrame) -> DataFrame:
        key = F.col("n_nationkey")
        wanted = pending.select(
            key.alias("request_id"), F.col("n_regionkey").alias("region"), (key * 4).alias("days_from"),
            (key * 4 + 30).alias("days_to"), F.lit(1).alias("level_from"), F.lit(25).alias("level_to"),
        )
        return churn_batch(t.user_activity, wanted, AS_OF)

    _run(streams.stream_requests(sheet, folder, done, run), folder)
    return t.spark.read.parquet(f"{folder}/result").drop("version")
