"""Inventory queries."""

from __future__ import annotations

from fleetwarden.operators import inventory as inv
from fleetwarden.plans.registry import query

JOBS = [
    "backups", "backup_alert", "error_logs", "partitions", "replication_mysql",
    "replication_mariadb", "replication_mssql", "objects_mysql", "objects_mssql", "accounts_mysql",
    "accounts_mssql", "sessions", "dictionary", "fleet", "site_map",
]


@query(
    """
    select s.id, s.ip, s.port, game_id || '@' || location || '-' || descr || ':' || dbusage as name,
      g.ip as gateway_ip, c.email_to, s.id_master
    from servers s left join gateways g using (game_id, location)
    left join contacts c on s.contact_id = c.id
    where dbtype in ('MySQL', 'MariaDB') and active = 1""",
    "servers gateways contacts",
)
def server_targets(t):
    return inv.server_targets(t.servers, t.gateways, t.contacts, inv.job_filter("accounts_mysql"))


@query(
    """
    with f as (select *, dbtype in ('MySQL', 'MariaDB') as m from servers)
    select 'backups' as job, id from f where m and active = 1 and dbusage like '%bkp%'
    union all select 'backup_alert', id from f where m and active = 1 and dbusage like '%bkp%'
      and game_id <> 'ASIA'
    union all select 'error_logs', id from f where dbtype = 'MySQL' and active = 1
    union all select 'partitions', id from f where m and active = 1
    union all select 'replication_mysql', id from f where dbtype = 'MySQL' and active = 1
      and id_master is not null
    union all select 'replication_mariadb', id from f where dbtype = 'MariaDB' and active = 1
      and id_master is not null
    union all select 'replication_mssql', id from f where dbtype = 'MSSQL' and active = 1
      and dbusage like '%dist%'
    union all select 'objects_mysql', id from f where m and active >= 1
    union all select 'objects_mssql', id from f where dbtype = 'MSSQL' and active >= 1
    union all select 'accounts_mysql', id from f where m and active = 1
    union all select 'accounts_mssql', id from f where dbtype = 'MSSQL' and active = 1
    union all select 'sessions', id from f where m
    union all select 'dictionary', id from f where dbtype in ('MySQL', 'MSSQL') and active >= 1
      and env = 'Live'
    union all select 'fleet', id from f where active <= 1
    union all select 'site_map', id from f where active < 2""",
    "servers",
)
def job_targets(t):
    filters = {job: inv.job_filter(job, excluded_games=("ASIA",)) for job in JOBS}
    return inv.job_targets(t.servers, filters)


@query(
    """
    select s.id, s.ip, s.port, game_id || '-' || location || '-' || descr as name,
      g.ip as gateway_ip, c.email_to, s.id_master
    from servers s left join gateways g using (game_id, location)
    left join contacts c on s.contact_id = c.id
    where dbtype = 'MSSQL' and active = 1 and dbusage like '%dist%'""",
    "servers gateways contacts",
)
def subscription_targets(t):
    where = inv.job_filter("replication_mssql")
    return inv.server_targets(t.servers, t.gateways, t.contacts, where, inv.subscription_name())


@query(
    """
    with hosts as (select ip, min(id) as id from servers
      where dbtype in ('MySQL', 'MariaDB') and active = 1 and dbusage like '%bkp%' group by ip),
    gates as (select game_id, location, min(ip) as gateway_ip from gateways group by all)
    select h.ip, game_id || '@' || location || '-' || descr || ':' || dbusage as name, gateway_ip, s.id,
      email_to
    from hosts h join servers s on h.id = s.id left join gates using (game_id, location)
    left join contacts c on s.contact_id = c.id""",
    "servers gateways contacts",
)
def backup_hosts(t):
    return inv.backup_hosts(t.servers, t.gateways, t.contacts, inv.job_filter("backups"))


@query(
    """
    select distinct game_id, location, lower(dbtype) as dbtype,
      case when lower(dbtype) = 'mssql' then 'mssql' else 'mysql' end as collector
    from servers""",
    "servers",
)
def dispatch_list(t):
    return inv.dispatch_list(t.servers)


@query(
    """
    select distinct game_id, lower(dbtype) as dbtype,
      case lower(dbtype) when 'mssql' then 'mssql' when 'mariadb' then 'mariadb' else 'mysql' end
        as collector
    from servers where id_master is not null""",
    "servers",
)
def dispatch_replication(t):
    return inv.dispatch_list(t.servers, replicas_only=True)


@query(
    """
    select id, name, email_to from contacts where id in (select contact_id from servers
      where dbtype in ('MySQL', 'MariaDB') and active = 1 and dbusage like '%bkp%')""",
    "servers contacts",
)
def alert_contacts(t):
    return inv.alert_contacts(t.contacts, t.servers, inv.job_filter("backups"))


@query(
    """
    select a.id, a.ip, a.id_master, b.ip as primary_ip from servers a
    left join servers b on a.id_master = b.id where a.id_master is not null""",
    "servers",
)
def primary_lookup(t):
    return inv.primary_lookup(t.servers)


@query(
    """
    select a.id, a.ip, a.id_master, b.ip as primary_ip, r.source_host from servers a
    left join servers b on a.id_master = b.id join reported_primaries r on a.id = r.id
    where a.id_master is not null and b.ip is distinct from r.source_host""",
    "servers reported_primaries",
)
def primary_mismatch(t):
    return inv.primary_mismatch(t.servers, t.reported_primaries)


@query(
    """
    select s.id, s.game_id, s.location, s.ip, s.port, g.ip as gateway_ip
    from servers s left join gateways g using (game_id, location)
    where descr like '%Supplier#%' and id_master is null""",
    "servers gateways",
)
def store_target(t):
    return inv.store_target(t.servers, t.gateways, word="supplier#")
