"""Queries of the collection and reconcile operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwarden.functions.text import client_null
from fleetwarden.operators import collect as col
from fleetwarden.operators import reconcile as rec
from fleetwarden.plans.registry import query
from fleetwarden.session import scratch_dir
from fleetwarden.sources import readers

SESSION_KEYS = ["dbserver_id", "user_name", "user_host"]

MERGED = """
    with m as (
      select coalesce(c.dbserver_id, s.dbserver_id) as dbserver_id,
        coalesce(c.user_name, s.user_name) as user_name, coalesce(c.user_host, s.user_host) as user_host,
        case when s.dbserver_id is not null then s.session_count else c.session_count end as session_count,
        case when s.dbserver_id is not null then 'run-2' else c.run_id end as run_id,
        case when c.dbserver_id is not null then c.creation_date
             else timestamp '2024-01-31 00:00:00' end as creation_date,
        case when c.dbserver_id is not null and s.dbserver_id is not null then 'update'
             when s.dbserver_id is not null then 'insert'
             when c.dbserver_id in (select dbserver_id from scope_servers) and c.dbserver_id not in
               (select dbserver_id from outcomes where not ok) then 'delete'
             else 'keep' end as change
      from sessions_old c full outer join sessions_new s on c.dbserver_id = s.dbserver_id
        and c.user_name = s.user_name and c.user_host = s.user_host)
"""
MERGED_TABLES = "sessions_old sessions_new scope_servers outcomes"


def _merged(t):
    return rec.reconcile(
        t.sessions_old, t.sessions_new, SESSION_KEYS, ["session_count"], "run-2",
        scope=t.scope_servers, protected=rec.protected_servers(t.outcomes, "run-2"),
        first_seen="creation_date", as_of="2024-01-31 00:00:00",
    )


@query(MERGED + "select * from m", MERGED_TABLES)
def reconcile(t):
    return _merged(t)


@query(MERGED + "select * exclude (change) from m where change <> 'delete'", MERGED_TABLES)
def new_state(t):
    return rec.new_state(_merged(t))


@query(MERGED + "select change, count(*) as row_count from m group by change", MERGED_TABLES)
def change_counts(t):
    return rec.change_counts(_merged(t))


@query("select distinct dbserver_id from outcomes where not ok", "outcomes")
def protected_servers(t):
    return rec.protected_servers(t.outcomes, "run-2")


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query(
    f"""
    select * exclude (rn) from (select *, row_number() over (
      partition by {", ".join(LINE_KEYS)} order by {", ".join(LINE_ORDER)}) as rn from lineitem)
    where rn = 1"""
)
def stage_dedupe(t):
    return rec.stage_dedupe(t.lineitem, LINE_KEYS, LINE_ORDER)


@query(
    """
    with old as (select distinct l_partkey, l_suppkey from lineitem where l_linestatus = 'O'),
    new as (select distinct l_partkey, l_suppkey from lineitem where l_linestatus = 'F')
    select l_partkey, l_suppkey, timestamp '2000-01-01 00:00:00' as first_seen from old
    union all
    select l_partkey, l_suppkey, timestamp '2002-01-01 00:00:00' from new n where not exists
      (select 1 from old o where o.l_partkey = n.l_partkey and o.l_suppkey = n.l_suppkey)"""
)
def insert_ignore(t):
    keys = ["l_partkey", "l_suppkey"]
    old = t.lineitem.filter("l_linestatus = 'O'").select(*keys).distinct()
    old = old.withColumn("first_seen", F.lit("2000-01-01 00:00:00").cast("timestamp"))
    new = t.lineitem.filter("l_linestatus = 'F'").select(*keys).distinct()
    return rec.insert_ignore(old, new, keys, "first_seen", "2002-01-01 00:00:00")


@query(
    """
    with s as (select l_orderkey, min(nullif(l_returnflag, 'N')) as o_orderstatus,
      max(l_linestatus) as o_orderpriority from lineitem group by l_orderkey)
    select o.o_orderkey, o.o_custkey,
      case when s.l_orderkey is not null then s.o_orderstatus else o.o_orderstatus end as o_orderstatus,
      case when s.l_orderkey is not null then s.o_orderpriority else o.o_orderpriority end
        as o_orderpriority
    from orders o left join s on o.o_orderkey = s.l_orderkey"""
)
def update_from(t):
    source = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(F.nullif("l_returnflag", F.lit("N"))).alias("o_orderstatus"),
        F.max("l_linestatus").alias("o_orderpriority"),
    )
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rec.update_from(target, source, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query(
    """
    select o_orderkey, cast(o_custkey as int) as dbserver_id, o_orderstatus as run_id from orders
    where not (o_orderstatus <> 'F' and o_custkey in (select dbserver_id from scope_servers)
      and o_custkey not in (select dbserver_id from outcomes where not ok))""",
    "scope_servers outcomes",
)
def delete_obsolete(t):
    state = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("dbserver_id"),
        F.col("o_orderstatus").alias("run_id"),
    )
    return rec.delete_obsolete(
        state, "F", scope=t.scope_servers, protected=rec.protected_servers(t.outcomes, "run-2")
    )


@query("select * from sessions", "sessions")
def session_counts(t):
    return col.session_counts(t.processlist)


@query(
    """
    select dbserver_id, count(*) as users, cast(sum(session_count) as bigint) as connections
    from sessions group by dbserver_id""",
    "sessions",
)
def session_totals(t):
    return col.session_totals(col.session_counts(t.processlist))


@query(
    r"""
    select dbserver_id, dbschema, 'table' as type, name,
      regexp_replace(definition, ' AUTO_INCREMENT=[0-9]*\b', '') as definition from object_tables
    union all select dbserver_id, dbschema, 'view', name, definition from object_views
    union all select dbserver_id, dbschema, 'event', name, definition from object_events
    union all select dbserver_id, dbschema, 'trigger', name, definition from object_triggers
    union all select dbserver_id, dbschema, 'procedure', name, definition from object_routines""",
    "object_tables object_views object_events object_triggers object_routines",
)
def object_snapshot(t):
    return col.object_snapshot(
        {
            "table": t.object_tables,
            "view": t.object_views,
            "event": t.object_events,
            "trigger": t.object_triggers,
            "procedure": t.object_routines,
        }
    )


@query(
    r"""
    select dbserver_id, dbschema, 'table' as type, name,
      regexp_replace(definition, ' AUTO_INCREMENT=[0-9]*\b', '') as definition from object_tables
    union all select dbserver_id, dbschema, 'view', name, definition from object_views
    union all select dbserver_id, dbschema, 'event', name, definition from object_events
    union all select dbserver_id, dbschema, 'trigger', name, definition from object_triggers
    union all select dbserver_id, dbschema, 'procedure', name, definition from object_routines""",
    "object_tables object_views object_events object_triggers object_routines",
)
def captured_objects(t):
    """The same rows over captured catalog output: one folder of lines per server and object type."""
    catalogs = {"table": t.object_tables, "view": t.object_views, "event": t.object_events,
                "trigger": t.object_triggers, "procedure": t.object_routines}
    read = {}
    for kind, objects in catalogs.items():
        fillers = [F.lit("x")] * (readers.DEFINITION_COLUMN[kind] - 2)
        line = F.concat_ws("\t", "dbschema", "name", *fillers, "definition")
        folder = scratch_dir(t.spark, f"captured-{kind}")
        objects.select("dbserver_id", line.alias("value")).write.partitionBy("dbserver_id").text(folder)
        read[kind] = readers.read_catalog(t.spark, folder, kind)
    return col.object_snapshot(read)


@query(
    r"""
    select doc_id, regexp_replace(replace(text, '. ', ' AUTO_INCREMENT=42 '),
      ' AUTO_INCREMENT=[0-9]*\b', '') as definition from documents"""
)
def normalise_definition(t):
    marked = F.replace("text", F.lit(". "), F.lit(" AUTO_INCREMENT=42 "))
    return col.normalise_definition(t.documents.select("doc_id", marked.alias("definition")))


@query(
    """
    select c.object, cast(0 as bigint) as part_no, 'CREATE TABLE ' || c.object || ' ' || string_agg(
      c.name || ' ' || y.name || '(' || c.max_length || ') ' ||
      case when k.object is null then '' else 'Primary Key' end || ',', ' ' order by c.column_id)
      as definition
    from ddl_columns c join ddl_types y using (user_type_id)
    left join ddl_keys k on k.object = c.object and k.column_id = c.column_id group by c.object""",
    "ddl_columns ddl_types ddl_keys",
)
def table_ddl(t):
    return col.table_ddl(t.ddl_columns, t.ddl_types, t.ddl_keys)


@query(
    """
    select schema_name, state_desc from schemata
    where schema_name not in ('small', 'tempdb') and state_desc = 'ONLINE'""",
    "schemata",
)
def schema_list(t):
    return col.schema_list(t.schemata, ["small", "tempdb"], online_only=True)


GRANTS = """
    select dbserver_id, account, cast(0 as bigint) as part_no, string_agg(statement || '; ', '' order by line_no)
      as definition
    from (select dbserver_id, line_no, 'u' || dbserver_id || '@%' as account,
        substr(line, strpos(line, ': ') + 2) as statement from grant_text) group by dbserver_id, account
"""


@query(GRANTS, "grant_text")
def grants_concat(t):
    return col.grants_concat(col.grant_lines(t.grant_text))


STATEMENTS = """
    with st as (
      select dbserver_id, name, '1login' as step, case when type = 'S' then
          'CREATE LOGIN [' || name || '] WITH PASSWORD=' || password_hash || ' HASHED,DEFAULT_DATABASE=['
          || default_database_name || '], DEFAULT_LANGUAGE=[' || default_language_name || ']; '
        else 'CREATE LOGIN [' || name || '] FROM WINDOWS; ' end ||
        case when is_disabled = 1 then ' ALTER LOGIN [' || name || '] DISABLED; ' else '' end as s
      from principals where type in ('S', 'U') and name not like '#%'
      union all
      select m.dbserver_id, m.name, '2role',
        'EXEC sp_addsrvrolemember ''' || m.name || ''',''' || r.name || '''; '
      from role_members x join principals r on x.dbserver_id = r.dbserver_id
        and x.role_principal_id = r.principal_id
      join principals m on x.dbserver_id = m.dbserver_id and x.member_principal_id = m.principal_id
      union all
      select p.dbserver_id, name, '3priv', 'GRANT ' || permission_name || ' TO [' || name || ']; '
      from server_permissions x join principals p on x.dbserver_id = p.dbserver_id
        and x.grantee_principal_id = p.principal_id
      where type in ('U', 'S') and name not like '#%' and permission_name <> 'CONNECT SQL'
      union all
      select dbserver_id, grantee_name, '4dbpriv-' || database_name || '-' || permission_name,
        case when permission_name = 'CONNECT' then 'USE [' || database_name || ']; CREATE USER [' ||
               grantee_name || ']; '
             when class_desc = 'DATABASE' then state_desc || ' ' || permission_name || ' TO [' ||
               grantee_name || ']; '
             else state_desc || ' ' || permission_name || ' ON ' || object_name || ' TO [' ||
               grantee_name || ']; ' end
      from db_permissions where database_name not in ('tempdb', 'model', 'msdb')
        and grantee_type_desc = 'SQL_USER' and grantee_principal_id <> 1 and grantee_name not like '#%'
      union all
      select dbserver_id, member_name, '5dbrole-' || database_name, 'USE [' || database_name ||
        ']; EXEC sp_addrolemember ''' || group_name || ''',''' || member_name || '''; '
      from db_members where member_uid <> 1 and member_name not like '#%'),
    statements as (select dbserver_id, name, step, rtrim(s) as statement from st)
"""
STATEMENT_TABLES = "principals role_members server_permissions db_permissions db_members"


def _statements(t):
    return col.grant_statements(
        t.principals, t.role_members, t.server_permissions, t.db_permissions, t.db_members
    )


@query(STATEMENTS + "select * from statements", STATEMENT_TABLES)
def grant_statements(t):
    return _statements(t)


@query(
    STATEMENTS
    + """
    select dbserver_id, name || '@%' as account, cast(0 as bigint) as part_no,
      string_agg(statement || ' ', '' order by step, statement) as definition
    from statements group by dbserver_id, name""",
    STATEMENT_TABLES,
)
def grants_ordered_concat(t):
    return col.grants_ordered_concat(_statements(t))


@query(
    f"""
    with g as ({GRANTS})
    select a.dbserver_id, user_name, user_host, nullif(password, 'NULL') as password,
      max_user_connections, case when g.account is not null then replace(g.definition, '; ', ';' || chr(10))
        else a.definition end as definition, cast(0 as bigint) as part_no
    from accounts a left join g on a.dbserver_id = g.dbserver_id
      and a.user_name || '@' || a.user_host = g.account""",
    "accounts grant_text",
)
def account_definition(t):
    return col.account_definition(t.accounts, col.grants_concat(col.grant_lines(t.grant_text)))


@query(
    """
    select dbserver_id, name as user_name, '%' as user_host, password_hash as password,
      0 as max_user_connections, cast(null as varchar) as definition
    from principals where type in ('U', 'S') and name not like '#%'""",
    "principals",
)
def login_list(t):
    return col.login_list(t.principals)


@query(
    r"""
    select dbserver_id, path as file, length as size,
      case when regexp_matches(path, '[0-9]{8}-[0-9]{6}') then
        strptime(regexp_extract(path, '([0-9]{8}-[0-9]{6})', 1), '%Y%m%d-%H%M%S') end as start_time,
      modified as end_time from backup_listing""",
    "backup_listing",
)
def backup_files(t):
    files = col.backup_files(t.backup_listing)
    return files.withColumnsRenamed({"start": "start_time", "end": "end_time"})


STATUS = """
    with logs as (select dbserver_id, log, bool_or(contains(line, ' the ')) as ok,
        arg_max(line, line_no) as last_line from backup_logs group by dbserver_id, log),
    newest as (select dbserver_id, regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, max(path) as file
      from backup_archives group by all),
    statuses as (select l.dbserver_id, log, case when ok then 'COMPLETE' else last_line end as status, file
      from logs l left join newest n on l.dbserver_id = n.dbserver_id
        and regexp_extract(l.log, '^(.*)/[^/]*$', 1) = n.dir)
"""
STATUS_TABLES = "backup_logs backup_archives"


def _doc_lines(t):
    """Lines of the documents: exploded here once, as the reader of real logs would give them."""
    return t.documents.select(
        "doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def _backup_logs(t):
    return _doc_lines(t).select(
        F.substring("source", 4, 10).cast("int").alias("dbserver_id"),
        F.concat(
            F.lit("/backup/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".log")
        ).alias("log"),
        "line_no",
        "line",
    )


def _statuses(t):
    return col.backup_status(_backup_logs(t), t.backup_archives, ok_mark=" the ")


@query(STATUS + "select * from statuses", STATUS_TABLES)
def backup_status(t):
    return _statuses(t)


@query(
    STATUS
    + """,
    last as (select dbserver_id, file, arg_max(status, log) as status from statuses group by all)
    select a.dbserver_id, a.path as file,
      case when l.file is not null then l.status else 'old' end as status
    from backup_archives a left join last l on a.dbserver_id = l.dbserver_id and a.path = l.file""",
    STATUS_TABLES,
)
def apply_backup_status(t):
    backups = t.backup_archives.select(
        "dbserver_id", F.col("path").alias("file"), F.lit("old").alias("status")
    )
    return col.apply_backup_status(backups, _statuses(t))


@query(
    """
    select doc_id, lang, nullif(source, 'src0') as source, text, '7' as run_id from documents"""
)
def tsv_rows(t):
    """Documents written as bulk-load lines and read back."""
    def escaped(c):
        for raw, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
            c = F.replace(c, F.lit(raw), F.lit(code))
        return c

    source = F.when(F.col("source") == "src0", "\\N").otherwise(F.col("source"))
    lines = t.documents.select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), "lang", source, escaped(F.col("text"))).alias(
            "line"
        )
    )
    return readers.parse_tsv(
        lines, "doc_id bigint, lang string, source string, text string", run_id="7"
    )


@query(
    """
    select dbserver_id, channel, nullif(lag, 'NULL') as lag, source_host from
    (select *, 'c' || event_id as channel from lags)""",
    "lags",
)
def record_fields(t):
    fields = readers.parse_records(t.channel_records)
    return fields.select(
        "dbserver_id", "channel", F.col("fields")["Seconds_Behind_Master"].alias("lag"),
        F.col("fields")["Master_Host"].alias("source_host"),
    )


@query("select event_id, nullif(lag, 'NULL') as lag from lags", "lags")
def client_nulls(t):
    return t.lags.select("event_id", client_null(F.col("lag")).alias("lag"))
