from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.operators import inventory as inv
from tests.conftest import rows

SERVERS = [
    # id, game, location, descr, usage, ip, port, kind, env, active, primary, contact
    (1, "G", "SG", "Store A", "main", "10.0.0.1", 3306, "MySQL", "Live", 1, None, 1),
    (2, "G", "SG", "Store A", "bkp", "10.0.0.1", 3307, "mysql", "Live", 1, 1, 1),
    (3, "G", "TH", None, "main", "10.0.0.3", 3306, "MariaDB", "Live", 1, 99, 2),
    (4, "H", "VN", "Core", "dist", "10.0.0.4", 1433, "MSSQL", "Test", 1, None, None),
    (5, "H", "VN", "Core", "bkp x", "10.0.0.5", 3306, "MySQL", "Live", 0, 1, 2),
    (6, "H", "XX", "Core", "BKP", "10.0.0.6", 3306, "MariaDB", "Live", 1, None, 2),
    (7, "H", "VN", "Core", "main", "10.0.0.7", 3306, "MySQL", "Live", 2, None, 2),
    (8, "H", "VN", "Core", "main", "10.0.0.8", 3306, "MySQL", "Live", None, None, 2),
]
GATEWAYS = [("10.9.0.1", "G", "SG"), ("10.9.0.2", "G", "SG"), ("10.9.0.3", "G", "TH")]
CONTACTS = [(1, "Ann", "ann@example.com"), (2, "Bo", "bo@example.com"), (3, "Cy", "cy@example.com")]


def fleet(table):
    return (
        table(SERVERS, schemas.SERVERS),
        table(GATEWAYS, schemas.GATEWAYS),
        table(CONTACTS, schemas.CONTACTS),
    )


def test_targets_fan_out_by_gateway_and_keep_sites_without_one(table):
    got = inv.server_targets(*fleet(table))
    count = {r["id"]: r["n"] for r in got.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert count == {1: 2, 2: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1}
    names = dict(rows(got, "id", "name"))
    assert names[1] == "G@SG-Store A:main"
    assert names[3] is None
    assert dict(rows(got, "id", "gateway_ip"))[6] is None
    assert [r["ip"] for r in got.collect()] == sorted(r["ip"] for r in got.collect())


def test_job_filters(table):
    servers, *_ = fleet(table)

    def ids(job, **options):
        return [r[0] for r in rows(servers.filter(inv.job_filter(job, **options)), "id")]

    assert ids("backups") == [2, 6]
    assert ids("backup_alert", excluded_games=("H",)) == [2]
    assert ids("error_logs") == [1, 2]
    assert ids("partitions", game_id="G", location="SG") == [1, 2]
    assert ids("replication_mysql") == [2]
    assert ids("replication_mysql", game_id="SG") == [2]
    assert ids("replication_mariadb") == [3]
    assert ids("replication_mssql") == [4]
    assert ids("objects_mysql") == [1, 2, 3, 6, 7]
    assert ids("objects_mysql", ip="10.0.0.7") == [7]
    assert ids("objects_mysql", game_id="G", location="TH", ip="10.0.0.7") == [3, 7]
    assert ids("accounts_mssql") == [4]
    assert ids("sessions") == [1, 2, 3, 5, 6, 7, 8]
    assert ids("dictionary") == [1, 2, 7]
    assert ids("fleet") == [1, 2, 3, 4, 5, 6]
    assert ids("site_map") == [1, 2, 3, 4, 5, 6]


def test_job_targets_agree_with_filters(table):
    servers, *_ = fleet(table)
    jobs = {job: inv.job_filter(job) for job in ("backups", "sessions", "fleet")}
    want = sorted((j, r[0]) for j, w in jobs.items() for r in servers.filter(w).select("id").collect())
    assert rows(inv.job_targets(servers, jobs)) == want


def test_backup_hosts_take_the_smallest_server_of_an_ip(table):
    got = inv.backup_hosts(*fleet(table))
    assert dict(rows(got, "ip", "id"))["10.0.0.1"] == 1
    assert got.count() == 7
    assert dict(rows(got, "ip", "gateway_ip"))["10.0.0.1"] == "10.9.0.1"


def test_dispatch(table):
    servers, *_ = fleet(table)
    assert ("H", "VN", "mssql", "mssql") in rows(inv.dispatch_list(servers))
    assert rows(inv.dispatch_list(servers, replicas_only=True)) == [
        ("G", "mariadb", "mariadb"), ("G", "mysql", "mysql"), ("H", "mysql", "mysql"),
    ]
    assert len(rows(inv.dispatch_list(servers, by_kind=False))) == 4


def test_contacts_and_routes(table):
    servers, _, contacts = fleet(table)
    assert rows(inv.alert_contacts(contacts, servers, inv.job_filter("backups")), "id") == [(1,), (2,)]
    alerts = table([(1, "x"), (9, "y")], "contact_id int, file string")
    assert rows(inv.route_to_contacts(alerts, contacts), "file", "email_to") == [
        ("x", "ann@example.com")
    ]


def test_primaries(table):
    servers, *_ = fleet(table)
    assert rows(inv.primary_lookup(servers), "id", "primary_ip") == [
        (2, "10.0.0.1"), (3, None), (5, "10.0.0.1"),
    ]
    reported = table(
        [(2, "10.0.0.1"), (3, "10.0.0.1"), (5, "10.0.0.2")], "id int, source_host string"
    )
    assert rows(inv.primary_mismatch(servers, reported), "id") == [(3,), (5,)]


def test_store_target(table):
    servers, gateways, _ = fleet(table)
    got = inv.store_target(servers, gateways, "G", "SG")
    assert rows(got, "id", "gateway_ip") == [(1, "10.9.0.1"), (1, "10.9.0.2")]
