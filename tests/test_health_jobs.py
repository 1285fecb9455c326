from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from fleetwarden.plans import health_jobs as hj
from fleetwarden.plans.health import _captured
from tests.conftest import rows
from tests.test_inventory import fleet


def put(folder, server, text, name="f.txt"):
    path = folder / f"dbserver_id={server}"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


def test_error_logs(spark, table, tmp_path):
    servers, *_ = fleet(table)
    put(tmp_path, 1, "2024-03-01 09:00:00 [ERROR] boom\n2024-03-01 09:01:00 [Note] Coordinator x\n2024-03-01 09:02:00 known\n"
        "2024-03-01 08:00:00 [ERROR] before\n  at trace\n")  # fmt: skip
    put(tmp_path, 4, "2024-03-01 09:00:00 [ERROR] other kind of server\n")
    patterns = table([("known",)], "pattern string")
    got = hj.error_log_findings(spark, str(tmp_path), servers, "2024-03-01 10:00:00", "hour", patterns)
    assert rows(got, "dbserver_id", "problem", "line") == [(1, "error", "2024-03-01 09:00:00 [ERROR] boom"), (2, "unreachable", None)]
    large = hj.error_log_findings(spark, str(tmp_path), servers, "2024-03-01 10:00:00", "hour", max_bytes=100)
    assert [r[:2] for r in rows(large, "dbserver_id", "problem")] == [(1, "oversize"), (2, "unreachable")]


def test_partitions(spark, table, tmp_path):
    servers, *_ = fleet(table)
    line = "s\tt\tp1\tRANGE\tUNIX_TIMESTAMP(ts)\t{}\n"
    put(tmp_path, 1, line.format(86400))
    put(tmp_path, 2, line.format(86400) + line.format("MAXVALUE"))
    put(tmp_path, 4, line.format(86400))
    got = hj.partition_findings(spark, str(tmp_path), servers, "2024-02-01")
    assert rows(got, "dbserver_id", "table_name", "last_bound") == [(1, "t", 86400)]


def test_replication(spark, table, tmp_path):
    servers, *_ = fleet(table)
    servers = servers.withColumn("id_master", F.when(F.col("id") != 4, 1))
    mark = "*************************** 1. row ***************************\n"
    (mysql, maria, mssql) = (tmp_path / n for n in ("mysql", "maria", "mssql"))
    put(mysql, 1, mark + "Seconds_Behind_Master: 5\n Last_Error: a: b\n")
    put(mysql, 7, mark + "Seconds_Behind_Master: NULL\n")
    got = hj.replication_findings(spark, str(mysql), servers, "replication_mysql")
    assert rows(got, "dbserver_id", "lag", "state") == [(2, None, "error")]
    put(maria, 3, mark + "Connection_name: a\nSeconds_Behind_Master: 18000\n" + mark + "Connection_name: b\nSeconds_Behind_Master: 1\n")
    put(maria, 6, mark + "Connection_name: c\nSeconds_Behind_Master: 0\n")
    got = hj.replication_findings(spark, str(maria), servers, "replication_mariadb")
    assert rows(got, "dbserver_id", "channel", "state") == [(3, "a", "lag")]
    put(mssql, 4, "status,warning,subscriber\n2,0,sub,p,db,6,7,8,99999,10,11,12,13,14,now,agent\n2,0,sub,p,ok,6,7,8,1,10,11,12,13,14,now,agent\n")
    got = hj.replication_findings(spark, str(mssql), servers, "replication_mssql")
    assert rows(got, "dbserver_id", "channel", "lag") == [(4, "sub.db", "99999")]


def test_captures_of_many_servers_are_few_files(spark, table):
    """Queries that capture a file per server do not write one each."""
    t = SimpleNamespace(spark=spark)
    lines = spark.range(3000, numPartitions=4).selectExpr("cast(id as int) as dbserver_id", "'2,0,sub,p,db,6,7,8,99999' as value")
    path = _captured(t, lines, "many")
    assert len(list(Path(path).rglob("part-*"))) <= 4
    servers, *_ = fleet(table)
    got = hj.replication_findings(spark, path, servers, "replication_mssql")
    assert rows(got, "dbserver_id", "channel", "lag") == [(4, "sub.db", "99999")]
