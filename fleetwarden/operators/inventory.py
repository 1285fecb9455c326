"""Server inventory: targets of each job, backup hosts, dispatch, contacts and primaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Database kinds and usage marks that the jobs select.
MYSQL, MARIADB, MSSQL = "MySQL", "MariaDB", "MSSQL"
MYSQL_LIKE = [MYSQL, MARIADB]
BACKUP_USAGE, DISTRIBUTOR_USAGE, STORE_DESCR = "bkp", "dist", "Store"


def _kind(kinds: list[str]) -> Column:
    return F.lower("dbtype").isin([k.lower() for k in kinds])


def _usage(word: str) -> Column:
    return F.lower("dbusage").contains(word.lower())


def job_filter(
    job: str,
    game_id: str | None = None,
    location: str | None = None,
    ip: str | None = None,
    excluded_games: tuple[str, ...] = (),
) -> Column:
    """The server filter of a job; without a site it covers every site at once.

    The replication jobs also take a location or game in ``game_id``; the object jobs take a
    single ``ip`` as an alternative to the site.
    """
    def scope() -> Column:
        wanted = {"game_id": game_id, "location": location}
        parts = [F.col(name) == value for name, value in wanted.items() if value is not None]
        return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)

    def game_or_location() -> Column:
        if game_id is None:
            return F.lit(True)
        return (F.col("game_id") == game_id) | (F.col("location") == game_id)

    def scope_or_ip() -> Column:
        if ip is None:
            return scope()
        listed = F.col("ip") == ip
        return listed if game_id is None and location is None else listed | scope()

    def active() -> Column:
        return F.col("active") == 1

    def known() -> Column:
        return F.col("active") >= 1

    def replica() -> Column:
        return active() & game_or_location() & F.col("id_master").isNotNull()

    filters = {
        "backups": lambda: _kind(MYSQL_LIKE) & active() & scope() & _usage(BACKUP_USAGE),
        "backup_alert": lambda: _kind(MYSQL_LIKE) & active() & scope() & _usage(BACKUP_USAGE)
        & ~F.col("game_id").isin(list(excluded_games)),
        "error_logs": lambda: _kind([MYSQL]) & active() & scope(),
        "partitions": lambda: _kind(MYSQL_LIKE) & active() & scope(),
        "replication_mysql": lambda: _kind([MYSQL]) & replica(),
        "replication_mariadb": lambda: _kind([MARIADB]) & replica(),
        "replication_mssql": lambda: _kind([MSSQL]) & active() & scope() & _usage(DISTRIBUTOR_USAGE),
        "objects_mysql": lambda: _kind(MYSQL_LIKE) & known() & scope_or_ip(),
        "objects_mssql": lambda: _kind([MSSQL]) & known() & scope_or_ip(),
        "accounts_mysql": lambda: _kind(MYSQL_LIKE) & active() & scope(),
        "accounts_mssql": lambda: _kind([MSSQL]) & active() & scope(),
        "sessions": lambda: _kind(MYSQL_LIKE) & scope(),
        "dictionary": lambda: _kind([MYSQL, MSSQL]) & known() & scope() & (F.col("env") == "Live"),
        "fleet": lambda: F.col("active") <= 1,
        "site_map": lambda: F.col("active") < 2,
    }
    return filters[job]()


def display_name() -> Column:
    """``game@location-descr:usage``; NULL if any part is."""
    return F.concat(
        "game_id", F.lit("@"), "location", F.lit("-"), "descr", F.lit(":"), "dbusage"
    )


def subscription_name() -> Column:
    """The shorter name that the subscription check uses: ``game-location-descr``."""
    return F.concat("game_id", F.lit("-"), "location", F.lit("-"), "descr")


def job_targets(servers: DataFrame, jobs: dict[str, Column]) -> DataFrame:
    """(job, id) for every job whose filter a server passes: one scan for all jobs."""
    passed = F.array(*[F.when(where, F.lit(job)) for job, where in jobs.items()])
    rows = servers.select("id", F.explode(passed).alias("job"))
    return rows.filter(F.col("job").isNotNull()).select("job", "id")


def server_targets(
    servers: DataFrame,
    gateways: DataFrame,
    contacts: DataFrame,
    where: Column | None = None,
    name: Column | None = None,
) -> DataFrame:
    """Servers with display name, gateway and contact address, ordered by ip.

    A site with two gateways gives two rows per server. Filters apply before the joins; the
    gateway and contact tables are broadcast by Spark where their measured size allows.
    """
    name = display_name() if name is None else name
    if where is not None:
        servers = servers.filter(where)
    gates = gateways.select(
        F.col("game_id"), F.col("location"), F.col("ip").alias("gateway_ip")
    )
    people = contacts.select(F.col("id").alias("contact_id"), "email_to")
    return (
        servers.select(
            "id", "ip", "port", "game_id", "location", "contact_id", "id_master", name.alias("name")
        )
        .join(gates, ["game_id", "location"], "left")
        .join(people, "contact_id", "left")
        .select("id", "ip", "port", "name", "gateway_ip", "email_to", "id_master")
        .orderBy("ip", "id", "gateway_ip")
    )


def backup_hosts(
    servers: DataFrame, gateways: DataFrame, contacts: DataFrame, where: Column | None = None
) -> DataFrame:
    """One row per ip: its smallest server id, and that server's name, gateway and contact.

    Of several gateways the smallest address is taken. Servers are reduced per ip before the
    joins, and gateways per site, so nothing fans out.
    """
    if where is not None:
        servers = servers.filter(where)
    hosts = servers.groupBy("ip").agg(
        F.min_by(
            F.struct("id", "game_id", "location", "contact_id", display_name().alias("name")), "id"
        ).alias("s")
    )
    gates = gateways.groupBy("game_id", "location").agg(F.min("ip").alias("gateway_ip"))
    people = contacts.select(F.col("id").alias("contact_id"), "email_to")
    return (
        hosts.select("ip", "s.*")
        .join(gates, ["game_id", "location"], "left")
        .join(people, "contact_id", "left")
        .select("ip", "name", "gateway_ip", "id", "email_to")
    )


def dispatch_list(
    servers: DataFrame, by_kind: bool = True, replicas_only: bool = False, where: Column | None = None
) -> DataFrame:
    """Distinct sites, each with the collector that serves its database kind.

    ``by_kind=False`` lists plain sites; ``replicas_only`` lists (game, kind) of servers that have
    a primary, as the replication check needs.
    """
    if where is not None:
        servers = servers.filter(where)
    if replicas_only:
        servers = servers.filter(F.col("id_master").isNotNull())
    sites = ["game_id"] if replicas_only else ["game_id", "location"]
    if not by_kind:
        return servers.select(*sites).distinct()
    kind = F.lower("dbtype")
    collector = (
        F.when(kind == MSSQL.lower(), "mssql")
        .when(F.lit(replicas_only) & (kind == MARIADB.lower()), "mariadb")
        .otherwise("mysql")
    )
    known = servers.filter(_kind([MYSQL, MSSQL, MARIADB]))
    return known.select(*sites, kind.alias("dbtype"), collector.alias("collector")).distinct()


def alert_contacts(contacts: DataFrame, servers: DataFrame, where: Column | None = None) -> DataFrame:
    """Contacts that own at least one matching server."""
    if where is not None:
        servers = servers.filter(where)
    owners = servers.select(F.col("contact_id").alias("id")).distinct()
    return contacts.join(owners, "id", "left_semi").select("id", "name", "email_to")


def route_to_contacts(alerts: DataFrame, contacts: DataFrame) -> DataFrame:
    """Alert rows with the address they go to; write them with ``partitionBy('contact_id')``."""
    people = contacts.select(F.col("id").alias("contact_id"), "name", "email_to")
    return alerts.join(people, "contact_id", "inner")


def primary_lookup(servers: DataFrame) -> DataFrame:
    """Every replica with the address of its configured primary (NULL if that is unknown)."""
    primaries = servers.select(F.col("id").alias("id_master"), F.col("ip").alias("primary_ip"))
    replicas = servers.filter(F.col("id_master").isNotNull()).select("id", "ip", "id_master")
    return replicas.join(primaries, "id_master", "left").select(
        "id", "ip", "id_master", "primary_ip"
    )


def primary_mismatch(servers: DataFrame, reported: DataFrame) -> DataFrame:
    """Replicas that replicate from another host than the configured one.

    ``reported`` has (id, source_host). A replica whose configured or reported host is unknown
    is a mismatch too.
    """
    found = primary_lookup(servers).join(reported.select("id", "source_host"), "id", "inner")
    return found.filter(~F.col("primary_ip").eqNullSafe(F.col("source_host")))


def store_target(
    servers: DataFrame,
    gateways: DataFrame,
    game_id: str | None = None,
    location: str | None = None,
    word: str = STORE_DESCR,
) -> DataFrame:
    """The primary (no id_master) servers whose description contains ``word``, with gateway."""
    where = F.lower("descr").contains(word.lower()) & F.col("id_master").isNull()
    if game_id is not None:
        where &= F.col("game_id") == game_id
    if location is not None:
        where &= F.col("location") == location
    gates = gateways.select("game_id", "location", F.col("ip").alias("gateway_ip"))
    return (
        servers.filter(where)
        .join(gates, ["game_id", "location"], "left")
        .select("id", "game_id", "location", "ip", "port", "gateway_ip")
    )
