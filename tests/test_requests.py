import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators import requests as rq
from fleetwarden.operators.prefix import ranged
from tests.conftest import rows

DAY = 86400
NOW = int(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc).timestamp())
AS_OF = "2024-01-31"


def activity(table):
    data = [
        (1, NOW - 2 * DAY, 5), (2, NOW - 2 * DAY - 1, 5), (3, NOW - DAY - 1, 5), (4, NOW - DAY, 5),
        (5, NOW - 2 * DAY + 5, 9), (6, NOW - 30 * DAY, 5), (7, NOW, 5),
    ]
    return table([(u, t, n, "sg") for u, t, n in data], schemas.USER_ACTIVITY + ", region string")


def test_churn_window_edges(table):
    users = activity(table)
    assert rows(rq.churn_cohort(users, 1, 1, 1, 5, AS_OF), "uid") == [(1,), (3,)]
    newest = [r["uid"] for r in rq.churn_cohort(users, 1, 1, 1, 9, AS_OF).collect()]
    assert newest == [3, 5, 1]
    assert rq.churn_cohort(users, 2, 1, 1, 9, AS_OF).count() == 0


def test_churn_batch_is_the_cohort_of_every_request(table):
    users = activity(table)
    wanted = [(1, "sg", 1, 1, 1, 5), (2, "sg", 0, 40, 1, 9), (3, "th", 0, 40, 1, 9), (4, "sg", 2, 1, 1, 9),
              (5, "sg", 9, 1, 1, 9)]
    requests = table(
        wanted, "request_id int, region string, days_from int, days_to int, level_from int, level_to int"
    )
    got = rows(rq.churn_batch(users, requests, AS_OF), "request_id", "uid")
    want = [
        (i, r["uid"]) for i, region, *p in wanted if region == "sg"
        for r in rq.churn_cohort(users, *p, AS_OF).collect()
    ]
    assert got == sorted(want)


SCORES = [(10, 0, 5), (11, -1, -10), (12, 100, 10), (13, 99, 9), (14, 100, 0)]


def test_scores(table):
    scores = table(SCORES, schemas.SCORES)
    accounts = table([(1, 12), (2, 13), (3, 10), (4, 99)], "acct_id bigint, sum_id bigint")
    assert rows(rq.score_list(accounts, scores, 100)) == [(1, 100)]
    assert rows(rq.score_list(accounts, scores, 0), "uid") == [(1,), (2,), (3,)]
    histogram = rq.score_histogram(scores, "harassment_score", 50)
    assert [tuple(r) for r in histogram.collect()] == [(-50, 1), (0, 1), (50, 1), (100, 2)]
    assert rows(rq.score_histogram(scores, "snitch_score", 10)) == [(-10, 1), (0, 3), (10, 1)]


def test_score_batches(table):
    scores = table([(*s, "sg") for s in SCORES], schemas.SCORES + ", region string")
    accounts = table([(1, 12, "sg"), (2, 13, "sg"), (3, 10, "sg")], "acct_id bigint, sum_id bigint, region string")
    requests = table(
        [(1, "sg", 100, 50), (2, "sg", 0, 10), (3, "th", 0, 10)],
        "request_id int, region string, cap int, width int",
    )
    assert rows(rq.score_batch(accounts, scores, requests), "request_id", "uid") == [
        (1, 1), (2, 1), (2, 2), (2, 3),
    ]
    got = rows(rq.score_histogram_batch(scores, requests))
    assert got == [
        (1, -50, 1), (1, 0, 1), (1, 50, 1), (1, 100, 2), (2, -10, 1), (2, 0, 1), (2, 90, 1), (2, 100, 2),
    ]


def test_shards(table, spark, tmp_path):
    wanted = table([(999999,), (1000000,), (1000000,), (1500000,)], "uid bigint")
    assert rows(rq.shard_plan(wanted)) == [
        (999999, 0, "00000000", True, True), (1000000, 1, "00000001", True, False),
        (1500000, 1, "00000001", False, True),
    ]
    with pytest.raises(Exception, match="no table suffix"):
        rq.shard_plan(table([(2 * 10**14,)], "uid bigint")).collect()
    uids = spark.range(0, 5000000, 250000).select(F.col("id").alias("uid"))
    profiles = rq.with_shard(uids.withColumn("regip", F.lit("x")))
    names = rq.with_shard(uids.withColumn("username", F.concat(F.lit("u"), F.col("uid").cast("string"))))
    for name, df in (("p", profiles), ("a", names)):
        df.write.partitionBy("shard").parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / n)) for n in ("p", "a")]
    got = rq.shard_lookup(wanted, *read)
    assert rows(got, "uid", "username") == [(1000000, "u1000000"), (1500000, "u1500000")]
    # Only the folders asked for are read: both scans are pruned by the requested ids, at run time.
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert len(filters) >= 2 and all("dynamicpruning" in f for f in filters)


def test_enrichment(table):
    target = table([(1, "old", "XX", 5), (2, "old", "XX", 5), (9, "old", "XX", 5)],
                   "uid bigint, username string, acc_country string, other int")
    info = table([(1, "new", None), (2, "two", "SG")], "uid bigint, username string, acc_country string")
    assert rq.updatable_columns(target) == ["acc_country", "username"]
    assert rows(rq.enrich_accounts(target, info)) == [
        (1, "new", None, 5), (2, "two", "SG", 5), (9, "old", "XX", 5),
    ]
    with pytest.raises(ValueError):
        rq.updatable_columns(table([(1,)], "uid bigint"))
    with pytest.raises(ValueError):
        rq.resolve_uid_by_name(table([("a",)], "username string"), info)


def test_uid_by_name_ignores_case(table):
    target = table([(0, "ANN"), (0, "bo"), (7, "nobody"), (8, ""), (9, None)], "uid bigint, username string")
    accounts = table([(5, "ann"), (4, "Ann"), (6, "BO"), (3, "")], "uid bigint, username string")
    assert rows(rq.resolve_uid_by_name(target, accounts)) == [
        (4, "ANN"), (6, "bo"), (7, "nobody"), (8, ""), (9, None),
    ]


def test_quota(table):
    requests = table(
        [(1, "b", 199997), (2, "b", 199998), (3, "zz", 1), (4, "empty", 200000), (5, "empty", 200001)],
        "request_id int, batch_id string, amount int",
    )
    batches = table([("b",), ("empty",)], "id string")
    codes = table([(str(i), "b") for i in range(3)], "id string, promo_batch_id string")
    got = rows(rq.quota_check(requests, batches, codes), "request_id", "existing", "accepted", "status")
    ok = "[Success] Promo Codes in the attachment inserted"
    assert got == [
        (1, 3, True, ok),
        (2, 3, False, "[Fail] There are 3 Promo Code(s) existing in bundle b. Max 200,000"),
        (3, 0, False, "[Fail] Invalid Bundle ID zz"),
        (4, 0, True, ok),
        (5, 0, False, "[Fail] There are 0 Promo Code(s) existing in bundle empty. Max 200,000"),
    ]
    assert rows(rq.first_per_batch(requests, ["request_id"]), "request_id") == [(1,), (3,), (4,)]


def in_order(requests, known, stock, limit):
    """{request_id: (existing, accepted)} by one running number per batch."""
    used, out = dict(stock), {}
    for i, batch, amount in sorted(requests, key=lambda r: r[0]):
        seen = used.get(batch, 0)
        ok = batch in known and amount is not None and seen + amount <= limit
        out[i] = (seen if batch is not None else 0, ok)
        if ok:
            used[batch] = seen + amount
    return out


@pytest.mark.parametrize("low", [0, -40])
def test_quota_in_order_of_any_sheet(table, low):
    generator = random.Random(low)
    requests = [
        (i, generator.choice(["hot", "hot", "hot", "b", "c", "no such", None]), generator.choice([None, 1, generator.randrange(low, 120)]))
        for i in range(300)
    ] + [(1000 + k, "stairs", amount) for k, amount in enumerate([1, 50, 1, 49, 1, 48, 60, 47, 2])]
    stock = {"hot": 3, "b": 200, "stairs": 0, "full": 7}
    batches = table([("hot",), ("b",), ("c",), ("stairs",)], "id string")
    codes = table([(str(i), b) for b, n in stock.items() for i in range(n)], "id string, promo_batch_id string")
    df = table(requests, "request_id int, batch_id string, amount int")
    got = rq.quota_in_order(df, batches, codes, limit=250 if low else 50)
    found = {r["request_id"]: (r["existing"], r["accepted"]) for r in got.collect()}
    assert found == in_order(requests, {"hot", "b", "c", "stairs"}, stock, 250 if low else 50)
    assert rq.quota_in_order(df.limit(0), batches, codes).count() == 0


def test_quota_in_order_spreads_the_hot_batch(spark):
    sheet = spark.range(6000).select(
        F.col("id").alias("request_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("batch_id"),
        F.lit(1).alias("amount"),
    )
    held = ranged(sheet, ["batch_id", "request_id"])
    assert held.filter("batch_id = 'hot'").select("_part").distinct().count() > 2
    batches = sheet.select(F.col("batch_id").alias("id")).distinct()
    none = spark.createDataFrame([], "id string, promo_batch_id string")
    got = rq.quota_in_order(sheet, batches, none, limit=1500)
    taken = got.filter("accepted and batch_id = 'hot'")
    assert taken.count() == 1500 and taken.agg(F.max("request_id")).first()[0] == 3 * 1499
    assert got.filter("not accepted and batch_id <> 'hot'").count() == 0


def test_codes(table):
    requests = table([(1, "b", 25000), (2, "c", 3)], "request_id int, batch_id string, amount int")
    none = table([], "id string")
    codes = rq.generate_codes(requests, none, "secret").cache()
    assert rows(codes.groupBy("request_id").count()) == [(1, 25000), (2, 3)]
    assert codes.select("code").distinct().count() == 25003
    assert codes.filter(~F.col("code").rlike("^[A-Z0-9]{16}$")).count() == 0
    again = rq.generate_codes(requests, none, "secret")
    assert codes.exceptAll(again).count() == 0
    # Codes that are taken already are replaced.
    taken = codes.filter("request_id = 2").limit(2).select(F.col("code").alias("id"))
    fresh = rq.generate_codes(requests, taken, "secret")
    assert rows(fresh.groupBy("request_id").count()) == [(1, 25000), (2, 3)]
    # All of them are taken: as many others are made.
    others = rq.generate_codes(requests, codes.select(F.col("code").alias("id")), "secret")
    assert rows(others.groupBy("request_id").count()) == [(1, 25000), (2, 3)]
    assert others.join(codes, "code").count() == 0
    assert rq.generate_codes(requests, none, "secret", run="2").join(codes, "code").count() == 0
    assert fresh.join(taken, fresh.code == taken.id).count() == 0
    row = rq.code_rows(codes.limit(1), "2024-01-31 10:00:00").collect()[0]
    assert row["account_id"] is None and row["active"] == 1 and str(row["created"]) == "2024-01-31 10:00:00"


def test_pending_requests(table):
    schema = "stamp string, user string, region string"
    sheet = table(
        [("1/1", "ann", "sg"), ("1/1", "ann", "sg"), ("1/1", "an", "sg"), ("1/1", "a.n", None), (None, None, None)],
        schema,
    )
    ledger = table([("1/1", "ann", "sg"), ("1/1", "annabel", "sg")], schema)
    assert rows(rq.pending_requests(sheet, ledger)) == [("1/1", "a.n", None), ("1/1", "an", "sg")]


def test_retention(table):
    logs = table(
        [(1, dt.datetime(2024, 1, 29)), (2, dt.datetime(2024, 1, 28, 23, 59, 59))], "id int, at timestamp"
    )
    assert rows(rq.retained(logs, "at", AS_OF, 2), "id") == [(1,)]
    assert rows(rq.retention_plan(logs, "at", AS_OF, 2)) == [("2024-01-28", 1)]


def test_retention_reads_the_listing_only(table, spark, tmp_path):
    from fleetwarden.sources import readers, retention

    path = str(tmp_path / "logs")
    days = spark.range(0, 400).select("id", F.expr("timestamp '2023-06-01 12:00:00' + make_interval(0, 0, 0, cast(id as int))").alias("at"))
    days.withColumn("month", F.date_format("at", "yyyy-MM")).write.partitionBy("month").parquet(path)
    (tmp_path / "logs" / "month=other").mkdir()
    (tmp_path / "logs" / "month=other" / "x.parquet").write_bytes((next((tmp_path / "logs").glob("month=2024-01/*.parquet"))).read_bytes())
    plan = retention.retention_folders(readers.read_listing(spark, path, "*.parquet"), "month", "2024-02-20 10:00:00", 15)
    assert "Parquet" not in plan._jdf.queryExecution().executedPlan().toString()
    actions = dict(rows(plan, "partition", "action"))
    assert actions["2024-01"] == "drop" and actions["2024-02"] == "trim" and actions["2024-03"] == actions["other"] == "keep"
    kept = {p.name for p in (tmp_path / "logs" / "month=2024-03").glob("*.parquet")}
    for _ in range(2):
        retention.apply_retention(spark, path, "month", "at", "2024-02-20 10:00:00", 15)
        left = spark.read.parquet(path).filter("month <> 'other'")
        assert rows(left.select("id")) == rows(days.filter("at >= timestamp '2024-02-05 00:00:00'").select("id"))
    assert {p.name for p in (tmp_path / "logs" / "month=2024-03").glob("*.parquet")} == kept
