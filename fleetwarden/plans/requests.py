"""Data-request queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwarden.operators import requests as rq
from fleetwarden.plans.registry import query
from fleetwarden.session import scratch_dir, stored
from fleetwarden.sources import readers, retention, sinks

AS_OF = "2001-08-02"
LOW_DAY = "date_diff('day', date '1970-01-01', date '2001-08-02')"


@query(
    f"""
    select uid, epoch_ms(last_active_time * 1000) as last_login_datetime, level from user_activity
    where last_active_time >= ({LOW_DAY} - 61) * 86400 and last_active_time < ({LOW_DAY} - 1) * 86400
      and level between 3 and 12""",
    "user_activity",
)
def churn_cohort(t):
    return rq.churn_cohort(t.user_activity, 1, 60, 3, 12, AS_OF)


@query(
    f"""
    select r.request_id, u.uid, epoch_ms(u.last_active_time * 1000) as last_login_datetime, u.level
    from user_activity u join churn_requests r on u.region = r.region
      and u.last_active_time >= ({LOW_DAY} - (r.days_to + 1)) * 86400
      and u.last_active_time < ({LOW_DAY} - r.days_from) * 86400
      and u.level between r.level_from and r.level_to""",
    "user_activity churn_requests",
)
def churn_batch(t):
    return rq.churn_batch(t.user_activity, t.churn_requests, AS_OF)


@query(
    """
    select a.acct_id as uid, s.harassment_score from score_accounts a
    join scores s on a.sum_id = s.summoner_id where s.harassment_score >= 100""",
    "score_accounts scores",
)
def score_list(t):
    return rq.score_list(t.score_accounts, t.scores, 100)


@query(
    """
    select r.request_id, a.acct_id as uid, s.harassment_score from score_requests r
    join scores s on r.region = s.region and s.harassment_score >= r.cap
    join score_accounts a on a.sum_id = s.summoner_id and a.region = s.region""",
    "score_accounts scores score_requests",
)
def score_batch(t):
    return rq.score_batch(t.score_accounts, t.scores, t.score_requests)


def _histogram(table: str, column: str, width: int) -> str:
    return f"""select cast(floor({column} / {width}) * {width} as bigint) as bucket, count(*) as row_count
      from {table} group by 1"""


@query(_histogram("scores", "harassment_score", 25), "scores")
def score_histogram(t):
    return rq.score_histogram(t.scores, "harassment_score", 25)


@query(_histogram("scores", "snitch_score", 500), "scores")
def score_histogram_second(t):
    return rq.score_histogram(t.scores, "snitch_score", 500)


@query(_histogram("orders", "o_totalprice", 5000))
def price_histogram(t):
    return rq.score_histogram(t.orders, "o_totalprice", 5000)


@query(
    """
    select r.request_id, cast(floor(s.harassment_score / r.width) * r.width as bigint) as bucket,
      count(*) as row_count
    from scores s join score_requests r on s.region = r.region group by 1, 2""",
    "scores score_requests",
)
def score_histogram_batch(t):
    return rq.score_histogram_batch(t.scores, t.score_requests)


@query(
    """
    with u as (select distinct uid, uid // 100 as shard from wanted_uids)
    select uid, shard, lpad(cast(shard as varchar), 8, '0') as suffix,
      uid = min(uid) over (partition by shard) as is_first,
      uid = max(uid) over (partition by shard) as is_last from u""",
    "wanted_uids",
)
def shard_plan(t):
    return rq.shard_plan(t.wanted_uids, width=100)


@query(
    """
    select p.uid, regip, acc_country, gender, username, email from profiles p
    join account_names a on p.uid = a.uid where p.uid in (select uid from wanted_uids)""",
    "profiles account_names wanted_uids",
)
def shard_lookup(t):
    profiles, accounts = (rq.with_shard(d, 100) for d in (t.profiles, t.account_names))
    return rq.shard_lookup(t.wanted_uids, profiles, accounts, width=100)


@query(
    """
    select o_orderkey, e.uid, case when i.uid is not null then i.username else e.username end as username,
      case when i.uid is not null then i.acc_country else e.acc_country end as acc_country
    from enrich_target e left join account_info i on e.uid = i.uid""",
    "enrich_target account_info",
)
def enrich_accounts(t):
    return rq.enrich_accounts(t.enrich_target, t.account_info)


@query(
    """
    with a as (select lower(username) as name, min(uid) as uid from account_names group by 1)
    select o_orderkey, coalesce(a.uid, n.uid) as uid, n.username
    from name_target n left join a on lower(n.username) = a.name""",
    "name_target account_names",
)
def resolve_uid_by_name(t):
    return rq.resolve_uid_by_name(t.name_target, t.account_names)


@query(
    """
    with e as (select r.*, b.id as known, coalesce(n, 0) as existing from code_requests r
      left join (select distinct id from code_batches) b on r.batch_id = b.id
      left join (select promo_batch_id, count(*) as n from stored_codes group by 1) c
        on r.batch_id = c.promo_batch_id)
    select request_id, batch_id, amount, existing,
      known is not null and existing + amount <= 100000 as accepted,
      case when known is null then '[Fail] Invalid Bundle ID ' || batch_id
           when existing + amount > 100000 then '[Fail] There are ' || existing ||
             ' Promo Code(s) existing in bundle ' || batch_id || '. Max 100,000'
           else '[Success] Promo Codes in the attachment inserted' end as status
    from e""",
    "code_requests code_batches stored_codes",
)
def quota_check(t):
    return rq.quota_check(t.code_requests, t.code_batches, t.stored_codes, limit=100_000)


@query(
    """
    select * exclude (rn) from (select *, row_number() over (partition by batch_id order by request_id)
      as rn from code_requests) where rn = 1""",
    "code_requests",
)
def first_per_batch(t):
    return rq.first_per_batch(t.code_requests, ["request_id"])


def _base36(value: str) -> str:
    """The low eight base-36 digits of ``value``."""
    return " || ".join(
        f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(({value} // {36**k}) % 36 as int) + 1, 1)"
        for k in reversed(range(8))
    )


CODES = f"""
    with made as (select request_id, batch_id, unnest(range(1, amount + 1)) as n from code_orders),
    hashed as (select request_id, batch_id, sha256('seed//' || batch_id || '/' || request_id || '/' || n) as h from made),
    halves as (select request_id, batch_id, cast(concat('0x', substr(h, 1, 15)) as bigint) as a,
      cast(concat('0x', substr(h, 16, 15)) as bigint) as b from hashed),
    codes as (select request_id, batch_id, {_base36("a")} || {_base36("b")} as code from halves)
"""


@query(CODES + "select * from codes", "code_orders")
def generate_codes(t):
    return rq.generate_codes(t.code_orders, t.code_stock, "seed")


@query(
    CODES
    + """
    select code as id, batch_id as promo_batch_id, timestamp '2024-01-31 00:00:00' as created,
      timestamp '2024-01-31 00:00:00' as modified, cast(null as bigint) as account_id, 1 as active
    from codes""",
    "code_orders",
)
def code_rows(t):
    codes = rq.generate_codes(t.code_orders, t.code_stock, "seed")
    return rq.code_rows(codes, "2024-01-31 00:00:00")


@query(
    """
    select distinct * from sheet s where not exists (select 1 from sheet_done d
      where s.requested = d.requested and s.requester = d.requester and s.region = d.region
        and s.kind = d.kind)""",
    "sheet sheet_done",
)
def pending_requests(t):
    return rq.pending_requests(t.sheet, t.sheet_done)


@query("select event_id, ts from events where ts >= timestamp '2024-01-26 00:00:00'")
def retained(t):
    return rq.retained(t.events.select("event_id", "ts"), "ts", "2024-01-31", 5)


@query(
    """
    select strftime(ts, '%Y-%m-%d') as day, count(*) as row_count from events
    where ts < timestamp '2024-01-26 00:00:00' group by 1"""
)
def retention_plan(t):
    return rq.retention_plan(t.events, "ts", "2024-01-31", 5)


def _orders_by_year(t) -> str:
    """The orders as a table partitioned by year on disk."""
    path = scratch_dir(t.spark, "orders-by-year")
    rows = t.orders.select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy").alias("year"))
    rows.repartition("year").write.partitionBy("year").parquet(path)
    return path


@query(
    """
    select strftime(o_orderdate, '%Y') as "partition", 1 as files,
      case when strftime(o_orderdate, '%Y') < '1999' then 'drop' when strftime(o_orderdate, '%Y') = '1999' then 'trim'
        else 'keep' end as action
    from orders group by 1, 3"""
)
def retention_folders(t):
    listing = readers.read_listing(t.spark, _orders_by_year(t), "*.parquet")
    return retention.retention_folders(listing, "year", "1999-07-04", 100).select("partition", "files", "action")


@query("select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1999-03-26 00:00:00'")
def retention_applied(t):
    path = _orders_by_year(t)
    retention.apply_retention(t.spark, path, "year", "o_orderdate", "1999-07-04", 100)
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderdate")


@query(
    """
    select * from (with recursive o as (
      select r.*, b.id is not null as known, coalesce(c.n, 0) as stock,
        row_number() over (partition by r.batch_id order by r.request_id) as rn
      from code_requests r left join (select distinct id from code_batches) b on r.batch_id = b.id
      left join (select promo_batch_id, count(*) as n from stored_codes group by 1) c
        on r.batch_id = c.promo_batch_id),
    f as (
      select *, stock as existing, known and stock + amount <= 100000 as accepted from o where rn = 1
      union all
      select o.*, f.existing + case when f.accepted then f.amount else 0 end as existing,
        o.known and f.existing + case when f.accepted then f.amount else 0 end + o.amount <= 100000 as accepted
      from f join o on o.batch_id = f.batch_id and o.rn = f.rn + 1)
    select request_id, batch_id, amount, existing, accepted,
      case when not known then '[Fail] Invalid Bundle ID ' || batch_id
           when not accepted then '[Fail] There are ' || existing || ' Promo Code(s) existing in bundle ' ||
             batch_id || '. Max 100,000'
           else '[Success] Promo Codes in the attachment inserted' end as status
    from f)""",
    "code_requests code_batches stored_codes",
)
def quota_in_order(t):
    return rq.quota_in_order(t.code_requests, t.code_batches, t.stored_codes, limit=100_000)


@query("select request_id, batch_id, amount as n_codes, amount as n_new from code_orders", "code_orders")
def issue_codes(t):
    """Exact amounts although two thirds of the codes of the same seed are in stock already."""
    first = rq.generate_codes(t.code_orders, t.code_stock, "seed")
    stock = first.filter(F.pmod(F.xxhash64("code"), F.lit(3)) != 0).select(F.col("code").alias("id"))
    codes = rq.generate_codes(t.code_orders, stock, "seed")
    old = stock.select(F.col("id").alias("code"), F.lit(1).alias("old"))
    return codes.join(old, "code", "left").groupBy("request_id", "batch_id").agg(
        F.countDistinct("code").cast("int").alias("n_codes"), F.count(F.when(F.col("old").isNull(), 1)).cast("int").alias("n_new")
    )


@query(
    """
    select o_orderkey, e.uid, case when i.uid is not null then i.username else e.username end as "Username",
      case when i.uid is not null then i.acc_country else e.acc_country end as acc_country
    from enrich_target e left join account_info i on e.uid = i.uid""",
    "enrich_target account_info",
)
def updatable_columns(t):
    """Columns are found and updated whatever their case."""
    return rq.enrich_accounts(t.enrich_target.withColumnRenamed("username", "Username"), t.account_info)


@query(
    """
    select a.acct_id as uid, s.harassment_score from score_accounts a
    join scores s on a.sum_id = s.summoner_id where s.harassment_score >= 50 and a.region = s.region""",
    "score_accounts scores",
)
def score_list_two_sources(t):
    """Scores kept apart from the accounts, as a table of its own in the shared folder."""
    scores = stored(t.scores.withColumnRenamed("region", "score_region"), "scores")
    high = rq.score_list(t.score_accounts, scores, 50)
    own = t.score_accounts.select(F.col("acct_id").alias("uid"), "region", "sum_id")
    at = scores.select(F.col("summoner_id").alias("sum_id"), "score_region", "harassment_score")
    same = own.join(at, (F.col("region") == F.col("score_region")) & (own["sum_id"] == at["sum_id"]))
    return high.join(same.select("uid", "harassment_score").distinct(), ["uid", "harassment_score"], "left_semi")


@query("select requested, requester, region, kind from sheet", "sheet")
def request_sheet(t):
    """The sheet as a CSV file with a header, every cell with a carriage return at its end."""
    names = ["requested", "requester", "region", "kind"]
    folder = scratch_dir(t.spark, "sheet")
    cells = [F.concat(F.col(c).cast("string"), F.lit("\r")).alias(c) for c in names]
    t.sheet.select(*cells).write.option("header", "true").csv(folder)
    return readers.read_sheet(t.spark, folder, names)


@query(
    """
    select o_orderkey, cast(o_orderdate as varchar) as o_orderdate, o_orderpriority || ', "' || o_orderstatus || '"' as note
    from orders"""
)
def csv_results(t):
    """Results as CSV, one folder per status, with quotes and separators inside a cell."""
    folder = scratch_dir(t.spark, "results")
    note = F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"'))
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("string"), note.alias("note"), "o_orderstatus")
    sinks.write_csv(rows, folder, by="o_orderstatus")
    schema = "o_orderkey bigint, o_orderdate string, note string, o_orderstatus string"
    read = t.spark.read.schema(schema).option("header", "true").option("escape", '\\')
    return read.csv(folder).drop("o_orderstatus")
