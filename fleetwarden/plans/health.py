"""Health-check and checksum queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwarden.operators import checksum as chk
from fleetwarden.operators import health as hl
from fleetwarden.operators.inventory import job_filter, route_to_contacts
from fleetwarden.plans import health_jobs as hj
from fleetwarden.plans.registry import query
from fleetwarden.plans.snapshots import _doc_lines
from fleetwarden.session import scratch_dir
from fleetwarden.sources.sinks import write_packed

AS_OF = "1999-07-04"

FAILED = """
    select h.contact_id, h.game_id, h.location, h.descr, h.ip, b.file, b.start as start_time,
      b."end" as end_time, b.status as failure_reason
    from backups b join hosts h on b.dbserver_id = h.id
    where b.start >= timestamp '1999-07-03' and b."end" < timestamp '1999-07-04'
      and coalesce(b.status, '') <> 'COMPLETE'
"""
MISSING = """
    select contact_id, game_id, location, ip, string_agg(descr, ',' order by id) as descr,
      'No backups found yesterday' as failure_reason
    from hosts where dbusage like '%bkp%' group by contact_id, game_id, location, ip
    having min(id) not in (select dbserver_id from backups
      where start >= timestamp '1999-07-03' and start < timestamp '1999-07-04')
"""
TIMES = {"start": "start_time", "end": "end_time"}


@query(FAILED, "backups hosts")
def failed_backups(t):
    return hl.failed_backups(t.backups, t.hosts, AS_OF).withColumnsRenamed(TIMES)


@query(f"select *, cast(0 as bigint) as part_no from ({MISSING})", "backups hosts")
def missing_backups(t):
    return hl.missing_backups(t.backups, t.hosts, AS_OF, job_filter("backup_alert"))


ALERT = f"""
    select contact_id, game_id, location, descr, ip, file, start_time, end_time, failure_reason, cast(0 as bigint) as part_no
    from ({FAILED})
    union all select contact_id, game_id, location, descr, ip, null, null, null, failure_reason, 0
    from ({MISSING})
"""


@query(ALERT, "backups hosts")
def backup_alert(t):
    alert = hl.backup_alert(t.backups, t.hosts, AS_OF, job_filter("backup_alert"))
    return alert.withColumnsRenamed(TIMES)


@query(
    f"""
    select a.contact_id, a.ip, a.failure_reason, c.name, c.email_to
    from ({ALERT}) a join contacts c on a.contact_id = c.id""",
    "backups hosts contacts",
)
def alert_routes(t):
    alert = hl.backup_alert(t.backups, t.hosts, AS_OF, job_filter("backup_alert"))
    return route_to_contacts(alert, t.contacts).select(
        "contact_id", "ip", "failure_reason", "name", "email_to"
    )


@query(
    """
    select * from log_lines where starts_with(line, '240115') or starts_with(line, '2024-01-15')""",
    "log_lines",
)
def log_window_day(t):
    return hl.log_window(t.log_lines, "2024-01-16 10:00:00", "day")


@query(
    """
    select * from log_lines where starts_with(line, '240116  9') or starts_with(line, '2024-01-16 09')""",
    "log_lines",
)
def log_window_hour(t):
    return hl.log_window(t.log_lines, "2024-01-16 10:00:00", "hour")


DROPPED = ["the ", "(c)", "que la", "http://", "@", "u. U"]


@query(
    "select doc_id, line_no, line from doc_lines where not ("
    + " or ".join(f"contains(line, '{p}')" for p in DROPPED)
    + ")",
    "doc_lines",
)
def log_exclude(t):
    return hl.log_exclude(_doc_lines(t).select("doc_id", "line_no", "line"), DROPPED)


@query(
    """
    select doc_id, line_no, line from doc_lines where not exists
      (select 1 from bench_lines where contains(line, pattern))""",
    "doc_lines bench_lines",
)
def log_exclude_table(t):
    lines = _doc_lines(t).select("doc_id", "line_no", "line")
    return hl.log_exclude_table(lines, t.bench_lines)


@query(
    """
    select doc_id, size, try_cast(size as bigint) // 1048576 as size_mib,
      case when try_cast(size as bigint) is null then 'unreachable'
           when try_cast(size as bigint) >= 16106127360 then 'oversize' else 'ok' end as state
    from log_sizes""",
    "log_sizes",
)
def log_size_alarm(t):
    return hl.log_size_alarm(t.log_sizes)


@query(
    """
    select dbserver_id, count(*) as error_lines from log_lines
    where (starts_with(line, '240115') or starts_with(line, '2024-01-15'))
      and not (contains(line, '[view]') or contains(line, 'code 6')) group by dbserver_id""",
    "log_lines",
)
def log_errors(t):
    return hl.log_errors(t.log_lines, "2024-01-16 10:00:00", "day", ["[view]", "code 6"])


@query(
    """
    with b as (select table_schema, table_name, partition_expression,
        max(try_cast(partition_description as bigint)) as last_bound,
        bool_or(partition_description = 'MAXVALUE') as is_open
      from range_partitions where partition_name is not null and partition_method = 'RANGE'
        and table_name not in ('t7') group by all),
    d as (select *, case when partition_expression like 'UNIX_TIMESTAMP%' then
          epoch_ms(last_bound * 1000)
        when partition_expression like 'TO_DAYS%' then
          cast(date '1970-01-01' + cast(last_bound - 719528 as int) as timestamp) end
        as last_bound_time from b)
    select table_schema, table_name, partition_expression, last_bound, last_bound_time from d
    where not is_open and last_bound_time <= timestamp '1999-01-02 00:00:00'""",
    "range_partitions",
)
def partition_horizon(t):
    return hl.partition_horizon(t.range_partitions, "1999-01-01", excluded_tables=["t7"])


LAG_STATE = """case when lag is null or not regexp_matches(lag, '^[0-9]+$') then 'error'
    when cast(lag as bigint) >= 18000 then 'lag' else 'ok' end as state"""


@query(f"select event_id, dbserver_id, lag, source_host, {LAG_STATE} from lags", "lags")
def replication_health(t):
    return hl.replication_health(t.lags)


@query(
    f"""
    select dbserver_id, channel, lag, source_host, {LAG_STATE}
    from (select dbserver_id, 'c' || event_id as channel, nullif(lag, 'NULL') as lag, source_host
      from lags)""",
    "lags",
)
def replication_channels(t):
    return hl.replication_channels(t.channel_records)


@query(
    f"""
    select *, {LAG_STATE} from (select dbserver_id, split_part(line, ',', 1) as status,
        split_part(line, ',', 3) as subscriber, split_part(line, ',', 5) as publisher_db,
        split_part(line, ',', 9) as lag, split_part(line, ',', 15) as last_sync,
        split_part(line, ',', 16) as agent
      from subscription_report where not (starts_with(line, '--') or
        starts_with(line, 'status,warning,') or contains(line, 'Changed database context')))""",
    "subscription_report",
)
def replication_subscriptions(t):
    return hl.replication_subscriptions(t.subscription_report)


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _checksum_sql(table: str, key: str, columns: list[str]) -> str:
    parts = " || ".join(
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in [key, *columns]
    )
    return f"""select chunk, count(*) as row_count, bit_xor(digest) as digest,
        cast(sum(digest % 2147483648) as bigint) as digest_sum
      from (select cast(floor({key} / 1000) as bigint) as chunk,
        cast(concat('0x', substr(md5({parts}), 1, 15)) as bigint) as digest from {table}) group by 1"""


def _diff_sql(primary: str, replica: str, key: str, columns: list[str]) -> str:
    return f"""select coalesce(p.chunk, r.chunk) as chunk, coalesce(p.row_count, 0) as primary_rows,
      coalesce(r.row_count, 0) as replica_rows
    from ({_checksum_sql(primary, key, columns)}) p
    full outer join ({_checksum_sql(replica, key, columns)}) r on p.chunk = r.chunk
    where p.row_count is distinct from r.row_count or p.digest is distinct from r.digest
      or p.digest_sum is distinct from r.digest_sum"""


@query(_checksum_sql("orders", "o_orderkey", ORDER_COLUMNS))
def table_checksum(t):
    return chk.table_checksum(t.orders, "o_orderkey", ORDER_COLUMNS, method="md5")


@query(_diff_sql("orders", "orders_replica", "o_orderkey", ORDER_COLUMNS), "orders_replica")
def checksum_diff(t):
    return chk.checksum_diff(t.orders, t.orders_replica, "o_orderkey", ORDER_COLUMNS)


TABLES = {
    ("shop", "orders"): ("orders", "orders_replica", "o_orderkey", ORDER_COLUMNS),
    ("shop", "customer"): ("customer", "customer_replica", "c_custkey", ["c_name", "c_nationkey"]),
    ("shop", "supplier"): ("supplier", "supplier_replica", "s_suppkey", ["s_name", "s_nationkey"]),
    ("mysql", "user"): ("customer", "customer_replica", "c_custkey", ["c_name", "c_nationkey"]),
}


@query(
    " union all ".join(
        f"select '{db}' as database_name, '{name}' as table_name, * from ({_diff_sql(*spec)})"
        for (db, name), spec in TABLES.items()
        if db != "mysql"
    ),
    "orders_replica customer_replica supplier_replica",
)
def checksum_tables(t):
    tables = {
        place: (t[primary], t[replica], key, columns)
        for place, (primary, replica, key, columns) in TABLES.items()
    }
    return chk.checksum_tables(tables)


@query(
    """
    select coalesce(p.o_orderkey, r.o_orderkey) as o_orderkey,
      case when r.o_orderkey is null then 'missing' else 'changed' end as state
    from orders p full outer join orders_replica r on p.o_orderkey = r.o_orderkey
    where r.o_orderkey is null or p.o_orderpriority <> r.o_orderpriority""",
    "orders_replica",
)
def table_diff(t):
    return chk.table_diff(t.orders, t.orders_replica, "o_orderkey", ORDER_COLUMNS)


def _captured(t, rows, name: str) -> str:
    """A file per server, as a collection leaves them, of (dbserver_id, value); packed, since servers are many."""
    server = F.coalesce(F.col("dbserver_id").cast("string"), F.lit("unknown"))
    file = F.concat(F.lit("dbserver_id="), server, F.lit("/captured.txt"))
    return write_packed(rows.select(file.alias("file"), "value"), scratch_dir(t.spark, name))


JOB_SERVERS = """s as (select id as dbserver_id, contact_id,
    game_id || '@' || location || '-' || descr || ':' || dbusage as name, dbtype, dbusage, id_master
  from servers where active = 1)"""


@query(
    f"""
    with {JOB_SERVERS}, w as (select * from s where dbtype = 'MySQL'),
    sizes as (select dbserver_id, sum(strlen(line) + 1) as size from log_lines group by 1)
    select contact_id, w.dbserver_id, name, case when size is null then 'unreachable' else 'oversize' end as problem,
      cast(size as varchar) as line
    from w left join sizes using (dbserver_id) where size is null or size >= 600
    union all select contact_id, dbserver_id, name, 'error', line
    from log_lines join w using (dbserver_id) join sizes using (dbserver_id)
    where size < 600 and (starts_with(line, '240115') or starts_with(line, '2024-01-15'))
      and not (contains(line, '[view]') or contains(line, 'code 6'))""",
    "servers log_lines",
)
def error_log_findings(t):
    path = _captured(t, t.log_lines.select("dbserver_id", F.col("line").alias("value")), "error-logs")
    patterns = t.spark.createDataFrame([("[view]",), ("code 6",)], "pattern string")
    return hj.error_log_findings(t.spark, path, t.servers, "2024-01-16 10:00:00", "day", patterns, max_bytes=600)


@query(
    f"""
    with {JOB_SERVERS}, w as (select * from s where dbtype in ('MySQL', 'MariaDB')),
    p as (select *, 1 + abs(cast(substr(table_name, 2) as int)) % 40 as dbserver_id from range_partitions),
    b as (select dbserver_id, table_schema, table_name, partition_expression,
        max(try_cast(partition_description as bigint)) as last_bound,
        bool_or(partition_description = 'MAXVALUE') as is_open
      from p where partition_name is not null and partition_method = 'RANGE' group by all),
    d as (select *, case when partition_expression like 'UNIX_TIMESTAMP%' then epoch_ms(last_bound * 1000)
        when partition_expression like 'TO_DAYS%' then
          cast(date '1970-01-01' + cast(last_bound - 719528 as int) as timestamp) end as last_bound_time from b)
    select contact_id, dbserver_id, name, table_schema, table_name, last_bound, last_bound_time
    from d join w using (dbserver_id) where not is_open and last_bound_time <= timestamp '1998-01-02 00:00:00'""",
    "servers range_partitions",
)
def partition_findings(t):
    fields = "table_schema table_name partition_name partition_method partition_expression partition_description"
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("\\N")) for c in fields.split()])
    server = F.expr("1 + abs(cast(substr(table_name, 2) as int)) % 40").alias("dbserver_id")
    path = _captured(t, t.range_partitions.select(server, line.alias("value")), "partitions")
    return hj.partition_findings(t.spark, path, t.servers, "1998-01-01")


@query(
    f"""
    with {JOB_SERVERS}, w as (select * from s where dbtype = 'MariaDB' and id_master is not null),
    st as (select dbserver_id, 'c' || event_id as channel, nullif(lag, 'NULL') as lag from lags),
    x as (select *, {LAG_STATE} from st)
    select contact_id, dbserver_id, name, channel, lag, state from x join w using (dbserver_id) where state <> 'ok'
    union all select contact_id, dbserver_id, name, null, null, 'error' from w
    where dbserver_id not in (select dbserver_id from lags)""",
    "servers lags",
)
def replication_findings(t):
    record = F.concat(F.lit("*************************** 1. row\n Connection_name: "), "channel", F.lit("\n"), "record")
    path = _captured(t, t.channel_records.select("dbserver_id", record.alias("value")), "replication")
    return hj.replication_findings(t.spark, path, t.servers, "replication_mariadb")


@query(
    f"""
    with {JOB_SERVERS}, w as (select * from s where dbtype = 'MSSQL' and lower(dbusage) like '%dist%'),
    st as (select dbserver_id, split_part(line, ',', 3) || '.' || split_part(line, ',', 5) as channel,
        split_part(line, ',', 9) as lag from subscription_report
      where not (starts_with(line, '--') or starts_with(line, 'status,warning,') or
        contains(line, 'Changed database context'))),
    x as (select *, {LAG_STATE} from st)
    select contact_id, dbserver_id, name, channel, lag, state from x join w using (dbserver_id) where state <> 'ok'
    union all select contact_id, dbserver_id, name, null, null, 'error' from w
    where dbserver_id not in (select dbserver_id from st)""",
    "servers subscription_report",
)
def subscription_findings(t):
    path = _captured(t, t.subscription_report.withColumnRenamed("line", "value"), "subscriptions")
    return hj.replication_findings(t.spark, path, t.servers, "replication_mssql")
