"""The given tables, and fleet tables derived from them by SQL that both engines run.

A derived table is one SELECT over given or other derived tables, written as ``{name}``. Where the
dialects differ the text uses the macros of ``DIALECTS``, as ``{name}`` too.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# What is written differently: quoted names, days since 1970, lines of a text with their number.
DIALECTS = {
    "spark": {
        "end_": "`end`",
        "order_day": "datediff(o_orderdate, date'1970-01-01')",
        "doc_lines": "select doc_id, source, lang, pos as line_no, line from {documents} "
        "lateral view posexplode(split(text, '\\n')) as pos, line",
        "bench_lines": "select distinct pattern from {benchmark} "
        "lateral view explode(split(text, '\\n')) as pattern where pattern <> ''",
    },
    "duckdb": {
        "end_": '"end"',
        "order_day": "date_diff('day', date '1970-01-01', cast(o_orderdate as date))",
        "doc_lines": "select doc_id, source, lang, cast(unnest(range(len(string_split(text, chr(10))))) as int) "
        "as line_no, unnest(string_split(text, chr(10))) as line from {documents}",
        "bench_lines": "select distinct pattern from "
        "(select unnest(string_split(text, chr(10))) as pattern from {benchmark}) where pattern <> ''",
    },
}

DERIVED = {
    # Inventory: suppliers are servers, nations are sites, regions are games and countries.
    "servers": """
        select cast(s_suppkey as int) as id, r_name as game_id, n_name as location, s_name as descr,
          case when s_acctbal < 2500 then 'bkp main' when s_acctbal < 5000 then 'dist'
               when s_acctbal < 7500 then 'Store bkp' else 'main' end as dbusage,
          concat('10.', cast(s_nationkey as string), '.',
                 cast(cast(floor((s_acctbal + 1000) / 2500) as bigint) as string), '.1') as ip,
          3306 as port,
          case when s_nationkey < 10 then 'MySQL' when s_nationkey < 17 then 'MariaDB'
               else 'MSSQL' end as dbtype,
          case when s_acctbal < 8000 then 'Live' else 'Test' end as env,
          case when s_acctbal < 0 then 0 when s_acctbal >= 9500 then 2 else 1 end as active,
          case when s_acctbal < 4000 then cast(floor(s_suppkey / 2) as int) end as id_master,
          s_nationkey as contact_id
        from {supplier} join {nation} on s_nationkey = n_nationkey
        join {region} on n_regionkey = r_regionkey""",
    "gateways": """
        select distinct concat('gw-', lower(c_mktsegment), '-', cast(c_nationkey as string)) as ip,
          r_name as game_id, n_name as location
        from {customer} join {nation} on c_nationkey = n_nationkey
        join {region} on n_regionkey = r_regionkey""",
    "contacts": """
        select n_nationkey as id, n_name as name, concat(lower(n_name), '@example.com') as email_to
        from {nation} where n_nationkey <> 3""",
    "locations": """
        select n_name as location, upper(substr(r_name, 1, 2)) as location_iso,
          r_name as location_name from {nation} join {region} on n_regionkey = r_regionkey""",
    "reported_primaries": """
        select r.id, case when r.contact_id < 12 then p.ip else r.ip end as source_host
        from {servers} r left join {servers} p on r.id_master = p.id""",
    # Sessions: line items are connections; events are two collections of session counts.
    "processlist": """
        select cast(l_suppkey as int) as dbserver_id, concat(l_returnflag, l_linestatus) as user_name,
          concat('h', cast(l_linenumber as string), ':', cast(l_partkey as string)) as host
        from {lineitem}""",
    "sessions": """
        select dbserver_id, user_name, split_part(host, ':', 1) as user_host, count(*) as session_count
        from {processlist} group by dbserver_id, user_name, split_part(host, ':', 1)""",
    "sessions_old": """
        select cast(user_id as int) as dbserver_id, event_type as user_name,
          substr(props, 7, length(props) - 7) as user_host, count(*) as session_count,
          'run-1' as run_id, cast('2024-01-16 00:00:00' as timestamp) as creation_date
        from {events} where ts < '2024-01-16 00:00:00'
        group by user_id, event_type, substr(props, 7, length(props) - 7)""",
    "sessions_new": """
        select cast(user_id as int) as dbserver_id, event_type as user_name,
          substr(props, 7, length(props) - 7) as user_host, count(*) as session_count
        from {events} where ts >= '2024-01-16 00:00:00'
        group by user_id, event_type, substr(props, 7, length(props) - 7)""",
    "scope_servers": """
        select cast(c_custkey as int) as dbserver_id from {customer} where c_acctbal >= 2000""",
    "outcomes": """
        select cast(c_custkey as int) as dbserver_id, 'run-2' as run_id,
          c_mktsegment <> 'BUILDING' as ok from {customer}""",
    # Accounts and grants.
    "principals": """
        select c_nationkey as dbserver_id, cast(c_custkey as int) as principal_id,
          case when c_acctbal < -800 then concat('#', c_name) else c_name end as name,
          case when c_mktsegment = 'AUTOMOBILE' then 'U' when c_mktsegment = 'MACHINERY' then 'R'
               else 'S' end as type,
          concat('0x', md5(c_name)) as password_hash, lower(c_mktsegment) as default_database_name,
          'us_english' as default_language_name,
          case when c_acctbal < 0 then 1 else 0 end as is_disabled
        from {customer}""",
    "role_members": """
        select m.dbserver_id, r.role_principal_id, m.principal_id as member_principal_id
        from {principals} m join (select dbserver_id, min(principal_id) as role_principal_id
          from {principals} where type = 'R' group by dbserver_id) r
        on m.dbserver_id = r.dbserver_id where m.type <> 'R'""",
    "server_permissions": """
        select distinct c_nationkey as dbserver_id, cast(c_custkey as int) as grantee_principal_id,
          case when o_orderpriority = '5-LOW' then 'CONNECT SQL' else o_orderpriority end
            as permission_name
        from {orders} join {customer} on o_custkey = c_custkey""",
    "db_permissions": """
        select p.dbserver_id,
          case when o_orderstatus = 'P' then 'tempdb' when o_orderstatus = 'F' then 'shop'
               else 'game' end as database_name,
          p.principal_id as grantee_principal_id, p.name as grantee_name,
          case when p.type = 'R' then 'DATABASE_ROLE' else 'SQL_USER' end as grantee_type_desc,
          case when o_orderpriority = '1-URGENT' then 'CONNECT' when o_orderpriority = '2-HIGH'
               then 'SELECT' else 'UPDATE' end as permission_name,
          case when o_orderpriority = '3-MEDIUM' then 'DATABASE' else 'OBJECT_OR_COLUMN' end
            as class_desc,
          'GRANT' as state_desc, concat('t', cast(o_orderkey as string)) as object_name
        from {orders} join {principals} p on o_custkey = p.principal_id""",
    "db_members": """
        select dbserver_id, default_database_name as database_name, principal_id as member_uid,
          name as member_name, 'db_datareader' as group_name from {principals}""",
    "grant_text": """
        select cast(o_custkey as int) as dbserver_id, o_orderkey as line_no,
          concat('Grants for u', cast(o_custkey as string), '@%: GRANT ', o_orderpriority,
                 ': x ON t', cast(o_orderkey as string)) as line from {orders}""",
    "accounts": """
        select cast(c_custkey as int) as dbserver_id, concat('u', cast(c_custkey as string)) as user_name,
          '%' as user_host,
          case when c_mktsegment = 'BUILDING' then 'NULL' else md5(c_name) end as password,
          0 as max_user_connections, 'none' as definition from {customer}""",
    # Objects.
    "object_tables": """
        select p_size as dbserver_id, p_type as dbschema,
          concat(replace(p_name, ' ', '_'), '_', cast(p_partkey as string)) as name,
          concat('CREATE TABLE t AUTO_INCREMENT=', cast(p_partkey as string), ' COMMENT=', p_brand,
                 ' AUTO_INCREMENT=7') as definition from {part}""",
    "object_views": """
        select c_nationkey as dbserver_id, c_mktsegment as dbschema, c_name as name,
          concat('CREATE VIEW v AUTO_INCREMENT=', cast(c_custkey as string)) as definition
        from {customer}""",
    "object_events": """
        select s_nationkey as dbserver_id, 'jobs' as dbschema, s_name as name, 'CREATE EVENT' as definition
        from {supplier}""",
    "object_triggers": """
        select n_regionkey as dbserver_id, 'jobs' as dbschema, n_name as name,
          'CREATE TRIGGER' as definition from {nation}""",
    "object_routines": """
        select r_regionkey as dbserver_id, 'jobs' as dbschema, r_name as name,
          'CREATE FUNCTION' as definition from {region}""",
    "ddl_columns": """
        select l_orderkey as object, l_linenumber as column_id,
          concat('c', cast(l_linenumber as string)) as name, cast(min(l_quantity) as int) as user_type_id,
          cast(max(l_quantity) as int) as max_length
        from {lineitem} group by l_orderkey, l_linenumber""",
    "ddl_types": """
        select p_size as user_type_id, lower(min(p_type)) as name from {part} group by p_size""",
    "ddl_keys": """
        select distinct l_orderkey as object, l_linenumber as column_id from {lineitem}
        where l_returnflag = 'R'""",
    "schemata": """
        select distinct lower(p_type) as schema_name,
          case when p_type = 'PROMO' then 'OFFLINE' else 'ONLINE' end as state_desc from {part}""",
    "dict_objects": """
        select p_size as dbserver_id, p_type as dbschema, 'table' as type,
          concat(replace(p_name, ' ', '_'), '_', cast(p_partkey as string)) as name,
          cast('2020-01-01 00:00:00' as timestamp) as creation_date,
          cast('2021-01-01 00:00:00' as timestamp) as modified_date from {part}""",
    "dictionary": """
        select distinct p_type as dbschema, concat(replace(p_name, ' ', '_'), '_NNN') as name,
          concat('^', upper(replace(p_name, ' ', '_')), '_[0-9]+$') as name_regexp,
          case when p_size >= 10 then concat('col', cast(cast(floor(p_size / 10) as int) as string)) end
            as column_name,
          concat('it', chr(39), 's | line', chr(13), chr(10), cast(cast(floor(p_size / 10) as int) as string))
            as comments,
          cast(floor(p_size / 10) as int) + 1 as line_num,
          case when p_size < 40 then cast('2022-03-04 05:06:07' as timestamp) end as creation_date,
          cast('2023-03-04 05:06:07' as timestamp) as modified_date
        from {part} where p_name not like 'red%'""",
    # Backups: orders are backups of customers' hosts; documents are logs and archives.
    "hosts": """
        select cast(c_custkey as int) as id, c_mktsegment as game_id, n_name as location, c_name as descr,
          case when c_acctbal >= 0 then 'bkp' else 'main' end as dbusage,
          concat('10.', cast(c_nationkey as string), '.',
                 cast(cast(floor((c_acctbal + 1000) / 1000) as bigint) as string), '.1') as ip,
          3306 as port, 'MySQL' as dbtype, 'Live' as env, 1 as active,
          cast(null as int) as id_master, c_nationkey as contact_id
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "backups": """
        select cast(o_custkey as int) as dbserver_id,
          concat('/backup/', cast(o_custkey as string), '/', cast(o_orderkey as string), '.gz') as file,
          o_orderdate as start,
          case when o_orderstatus <> 'P' then o_orderdate + interval '6' hour end as {end_},
          case when o_orderstatus = 'F' then 'COMPLETE' when o_totalprice > 250000 then 'exit 1' end
            as status
        from {orders}""",
    "backup_listing": """
        select cast(o_custkey as int) as dbserver_id,
          concat('/backup/', cast(o_custkey as string), '/full-',
            case when o_orderstatus = 'P' then '' else concat(
              replace(cast(cast(o_orderdate as date) as string), '-', ''), '-0',
              substr(o_orderpriority, 1, 1), '3015') end, '.gz') as path,
          o_orderkey as length, o_orderdate as modified from {orders}""",
    "doc_lines": "{doc_lines_}",
    "backup_logs": """
        select cast(substr(source, 4) as int) as dbserver_id,
          concat('/backup/', source, '/', cast(doc_id as string), '.log') as log, line_no, line
        from {doc_lines}""",
    "backup_archives": """
        select cast(substr(source, 4) as int) as dbserver_id,
          concat('/backup/', source, '/', lang, '-', cast(doc_id as string), '.gz') as path
        from {documents}""",
    # Logs, status reports and partitions.
    "log_lines": """
        select cast(user_id as int) as dbserver_id, event_id,
          concat(case when event_type = 'error' then
              concat(substr(t, 3, 2), substr(t, 6, 2), substr(t, 9, 2), ' ',
                case when substr(t, 12, 1) = '0' then ' ' else substr(t, 12, 1) end, substr(t, 13))
            when event_type = 'signup' then concat('at ', t) else t end,
            ' [', event_type, '] code ', substr(props, 7, length(props) - 7)) as line
        from (select *, substr(cast(ts as string), 1, 19) as t from {events})""",
    "log_sizes": """
        select doc_id, case when lang = 'fr' then 'denied' else cast(n_chars * 1000000 as string) end
          as size from {documents}""",
    "bench_lines": "{bench_lines_}",
    "lags": """
        select event_id, cast(user_id as int) as dbserver_id,
          case when event_type = 'view' then 'NULL' when event_type = 'signup' then '1.5'
               else cast(cast(floor(value * 100) as bigint) as string) end as lag,
          concat('h', substr(props, 7, length(props) - 7)) as source_host from {events}""",
    "channel_records": """
        select dbserver_id, concat('c', cast(event_id as string)) as channel,
          concat('*** 1. row ***', chr(10), '  Master_Host: ', source_host, chr(10),
            ' Seconds_Behind_Master: ', lag, chr(10), ' Last_Error: a: b', chr(10)) as record
        from {lags}""",
    "subscription_report": """
        select cast(l_suppkey as int) as dbserver_id, concat(l_linestatus, ',w,sub',
          cast(l_linenumber as string), ',x,db', cast(l_partkey as string), ',6,7,8,',
          case when l_returnflag = 'R' then 'NULL' else cast(cast(floor(l_extendedprice) as bigint) as string) end,
          ',10,11,12,13,14,', substr(cast(l_shipdate as string), 1, 10), ',agent', l_returnflag) as line
        from {lineitem}
        union all select r_regionkey, 'status,warning,subscriber' from {region}
        union all select r_regionkey, '------,-------' from {region}
        union all select r_regionkey, concat('Changed database context to ', r_name) from {region}""",
    "range_partitions": """
        select lower(o_orderpriority) as table_schema, concat('t', cast(o_custkey as string)) as table_name,
          case when o_totalprice > 2000 then concat('p', cast(o_orderkey as string)) end as partition_name,
          case when o_totalprice < 450000 then 'RANGE' else 'HASH' end as partition_method,
          case when o_orderstatus = 'F' then 'UNIX_TIMESTAMP(ts)' when o_orderstatus = 'O'
               then 'TO_DAYS(d)' else 'id' end as partition_expression,
          case when o_totalprice > 440000 then 'MAXVALUE'
               when o_orderstatus = 'F' then cast({order_day} * 86400 as string)
               when o_orderstatus = 'O' then cast({order_day} + 719528 as string)
               else cast(o_orderkey as string) end as partition_description
        from {orders}""",
    # Replicas: some rows are changed, some are missing.
    "orders_replica": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
          case when o_totalprice > 499000 then '9-LATE' else o_orderpriority end as o_orderpriority
        from {orders} where o_totalprice >= 1500""",
    "customer_replica": """
        select c_custkey, case when c_acctbal > 9990 then 'x' else c_name end as c_name, c_nationkey
        from {customer}""",
    "supplier_replica": "select s_suppkey, s_name, s_nationkey from {supplier}",
    # Data requests.
    "user_activity": """
        select o_custkey as uid, n_regionkey as region, max({order_day}) * cast(86400 as bigint) + 3600
          as last_active_time, cast(count(*) as int) as level
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
        group by o_custkey, n_regionkey""",
    "churn_requests": """
        select n_nationkey as request_id, n_regionkey as region, n_nationkey * 4 as days_from,
          n_nationkey * 4 + 30 as days_to, 1 + n_regionkey as level_from, 25 as level_to
        from {nation}""",
    "score_accounts": """
        select c_custkey as acct_id, c_custkey * 7 + 3 as sum_id, n_regionkey as region
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "scores": """
        select o_custkey * 7 + 3 as summoner_id, n_regionkey as region,
          cast(count(*) * 10 as int) as harassment_score,
          cast(floor(min(c_acctbal)) as int) as snitch_score
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
        group by o_custkey, n_regionkey""",
    "score_requests": """
        select n_nationkey as request_id, n_regionkey as region, 80 + n_nationkey * 2 as cap,
          20 + n_nationkey as width from {nation}""",
    "profiles": """
        select c_custkey as uid, concat('10.0.0.', cast(c_nationkey as string)) as regip,
          substr(c_mktsegment, 1, 2) as acc_country, c_nationkey as gender from {customer}""",
    "account_names": """
        select c_custkey as uid, c_name as username, concat(lower(c_mktsegment), '@example.com') as email
        from {customer}""",
    "wanted_uids": "select o_custkey as uid from {orders}",
    "account_info": """
        select c_custkey as uid, case when c_acctbal < 5000 then c_mktsegment end as acc_country,
          c_name as username, c_nationkey as gender from {customer} where c_acctbal >= 0""",
    "enrich_target": """
        select o_orderkey, o_custkey as uid, 'unknown' as username, 'XX' as acc_country from {orders}""",
    "name_target": """
        select o_orderkey, cast(-1 as bigint) as uid,
          concat('CUSTOMER#', lpad(cast(o_custkey as string), 9, '0')) as username from {orders}""",
    "code_requests": """
        select o_orderkey as request_id, o_custkey + 600 as batch_id,
          cast(floor(o_totalprice / 3) as int) as amount from {orders}""",
    "code_batches": "select p_partkey as id from {part}",
    "stored_codes": """
        select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as id,
          l_partkey as promo_batch_id from {lineitem}""",
    "code_orders": """
        select n_nationkey as request_id, n_nationkey as batch_id, cast(count(*) as int) as amount
        from {customer} join {nation} on c_nationkey = n_nationkey group by n_nationkey""",
    "code_stock": "select upper(substr(md5(c_name), 1, 16)) as id from {customer}",
    "sheet": """
        select substr(cast(o_orderdate as string), 1, 19) as requested, cast(o_custkey as string) as requester,
          o_orderpriority as region, o_orderstatus as kind from {orders}""",
    "sheet_done": """
        select substr(cast(o_orderdate as string), 1, 19) as requested, cast(o_custkey as string) as requester,
          o_orderpriority as region, o_orderstatus as kind
        from {orders} where o_orderdate < '1998-01-01 00:00:00'""",
}


def _template(name: str, dialect: str) -> str:
    """The SELECT of a derived table with the dialect's macros filled in."""
    macros = DIALECTS[dialect]
    text = DERIVED[name]
    for macro, place in (("doc_lines", "{doc_lines_}"), ("bench_lines", "{bench_lines_}")):
        text = text.replace(place, macros[macro])
    return text.replace("{end_}", macros["end_"]).replace("{order_day}", macros["order_day"])


def _inputs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


class Tables:
    """Given and derived tables of one data folder, as attributes or by item."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")
        self.opened: dict[str, DataFrame] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.opened:
            if name in GIVEN:
                self.opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = _template(name, "spark")
                self.opened[name] = self.spark.sql(text, **{n: self[n] for n in _inputs(text)})
        return self.opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN or name in DERIVED:
            return self[name]
        raise AttributeError(name)


def with_tables(names: str, sql: str) -> str:
    """``sql`` for DuckDB, after the common table expressions of the named derived tables."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in GIVEN or name in done:
            return
        text = _template(name, "duckdb")
        for used in _inputs(text):
            add(used)
        done[name] = re.sub(r"\{(\w+)\}", r"\1", text)

    for name in names.split():
        add(name)
    if not done:
        return sql
    tables = ", ".join(f"{name} as ({text.strip()})" for name, text in done.items())
    sql = sql.strip()
    if sql.lower().startswith("with "):
        return f"with {tables}, {sql[5:]}"
    return f"with {tables} {sql}"



