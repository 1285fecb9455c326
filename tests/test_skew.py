"""A key with a third of all rows: joins split it at run time, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from fleetwarden.operators import concat as cc
from fleetwarden.operators import health as hl
from fleetwarden.operators import prefix as px
from fleetwarden.operators import reconcile as rec
from fleetwarden.operators import requests as rq

SETTINGS = {
    # Off, as in a session that this library did not make: the plans must allow the split as they are.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def no_broadcast(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key in SETTINGS:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def hot(spark, n=60000):
    """Rows whose key is 7 in every third one."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("uid"),
        F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_update_splits_the_hot_key(no_broadcast):
    source = no_broadcast.range(500).select(F.col("id").alias("uid"), F.lit("new").alias("text"))
    got = rec.update_from(hot(no_broadcast), source, ["uid"], ["text"])
    assert "skew=true" in final_plan(got)
    assert got.count() == 60000 and got.filter("text <> 'new'").count() == 0


def test_update_from_grouped_rows_splits_the_hot_key(no_broadcast):
    target = hot(no_broadcast).withColumn("uid", F.when(F.col("n") != 1, F.col("uid")))
    source = hot(no_broadcast, 6000).groupBy("uid").agg(F.lit("new").alias("text"))
    source = source.unionByName(no_broadcast.sql("select cast(null as bigint) uid, 'null' text"))
    got = rec.update_from(target, source, ["uid"], ["text"])
    assert "skew=true" in final_plan(got)
    assert got.count() == 60000 and got.filter("text <> 'new'").count() == 1


def test_reconcile_splits_the_hot_server(no_broadcast):
    state = hot(no_broadcast).select(F.col("uid").alias("server"), "n", "text", F.lit("r1").alias("run_id"))
    staged = state.filter("n % 2 = 0").select("server", "n", "text")
    got = rec.reconcile(
        state, staged, ["server", "n"], ["text"], "r2", server="server",
        scope=no_broadcast.range(400), protected=no_broadcast.range(100),
    )
    assert "skew=true" in final_plan(got)
    counts = {r[0]: r[1] for r in rec.change_counts(got).collect()}
    kept = state.filter("n % 2 = 1 and (server < 100 or server >= 400)").count()
    assert counts == {"update": 30000, "keep": kept, "delete": 30000 - kept}


def test_name_lookup_splits_the_hot_name(no_broadcast):
    accounts = hot(no_broadcast).select(
        F.col("n").alias("uid"), F.concat(F.lit("User"), F.col("uid").cast("string")).alias("username"), "text"
    )
    target = no_broadcast.range(600).select(
        F.lit(-1).cast("bigint").alias("uid"), F.concat(F.lit("USER"), F.col("id").cast("string")).alias("username")
    )
    got = rq.resolve_uid_by_name(target, accounts)
    assert "skew=true" in final_plan(got)
    found = {r["username"]: r["uid"] for r in got.collect()}
    assert len(found) == 600 and found["USER7"] == 0 and found["USER8"] == 8 and found["USER599"] == -1


def test_quota_splits_the_hot_batch(no_broadcast):
    requests = hot(no_broadcast).select(
        F.col("n").alias("request_id"), F.col("uid").alias("batch_id"), F.lit(1).alias("amount"), "text"
    )
    batches = no_broadcast.range(400)
    codes = hot(no_broadcast, 6000).select(F.col("uid").alias("promo_batch_id"))
    got = rq.quota_check(requests, batches, codes)
    assert "skew=true" in final_plan(got)
    assert got.count() == 60000


def test_cohort_batch_splits_the_hot_day(no_broadcast):
    users = hot(no_broadcast).select(
        "uid", F.lit("sg").alias("region"), F.lit(1).alias("level"),
        (F.lit(1706572800) - 86400 * F.when(F.col("n") % 3 == 0, 1).otherwise(F.col("n") % 97)).alias(
            "last_active_time"
        ),
    )
    requests = no_broadcast.createDataFrame(
        [(1, "sg", 0, 200, 1, 1)],
        "request_id int, region string, days_from int, days_to int, level_from int, level_to int",
    )
    got = rq.churn_batch(users, requests, "2024-01-31")
    assert "skew=true" in final_plan(got)
    assert got.count() == 60000


def test_exclusion_join_keeps_every_line_once(no_broadcast):
    lines = hot(no_broadcast, 900).select("n", F.concat("text", F.lit(" end")).alias("line"))
    patterns = no_broadcast.createDataFrame([("00",), ("abc",), ("a1b",), ("nope nope",)], "pattern string")
    got = hl.log_exclude_table(lines, patterns)
    want = [r["n"] for r in lines.collect() if not any(p in r["line"] for p in ("00", "abc", "a1b"))]
    assert sorted(r["n"] for r in got.collect()) == want


def test_concatenation_spreads_the_hot_key(no_broadcast):
    """A key with a third of all rows lies in many partitions, and its parts are its whole text."""
    no_broadcast.conf.set("spark.sql.shuffle.partitions", "24")
    rows = hot(no_broadcast, 30000)
    lined = rows.withColumn("_key", F.struct("uid")).withColumn("_text", F.col("text")).withColumn("_order0", F.col("n"))
    held = px.ranged(lined, ["_key", "_order0", "_text"])
    spread = held.filter("uid = 7").groupBy("_part").count().collect()
    assert len(spread) > 5 and max(r["count"] for r in spread) < 5000
    ends = held.filter("uid = 7").groupBy("_part").agg(F.min("n").alias("low"), F.max("n").alias("high")).orderBy("_part").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ends, ends[1:]))

    no_broadcast.conf.set("spark.sql.shuffle.partitions", "8")
    keyed = rows.withColumn("uid", F.when(F.col("uid") != 3, F.col("uid")))  # NULL is a key too
    got = cc.ordered_concat(keyed, ["uid"], F.col("text"), [F.col("n")], ",", out="all", max_cell_bytes=20_000, last=["n"])
    found, most = {}, {}
    for r in sorted(got.collect(), key=lambda r: r["part_no"]):
        found.setdefault(r["uid"], []).append(r["all"])
        most[r["uid"]] = r["n"]
        assert len(r["all"]) <= 20_000
    want = {}
    for r in sorted(keyed.collect(), key=lambda r: r["n"]):
        want.setdefault(r["uid"], []).append(r)
    assert {k: ",".join(v) for k, v in found.items()} == {k: ",".join(r["text"] for r in v) for k, v in want.items()}
    assert most == {k: v[-1]["n"] for k, v in want.items()}
    assert len(found[7]) > 50 and len(found[9]) == 1
