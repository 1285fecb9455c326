"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwarden.functions.text import comment_markup
from fleetwarden.operators import collect as col
from fleetwarden.operators import health as hl
from fleetwarden.operators import reports as rep
from fleetwarden.operators.inventory import job_filter
from fleetwarden.plans.health import ALERT, AS_OF
from fleetwarden.plans.registry import query
from fleetwarden.sources import sinks

SUMMARY = """
    select game_id, location, dbtype, c.name as contact, count(*) as servers,
      cast(sum(case when p.n is null then 1 else 0 end) as bigint) as no_sessions,
      cast(sum(case when active <> 1 then 1 else 0 end) as bigint) as inactive
    from servers s join contacts c on s.contact_id = c.id
    left join (select dbserver_id, sum(session_count) as n from sessions group by dbserver_id) p on s.id = p.dbserver_id
    where active <= 1 group by game_id, location, dbtype, c.name
"""
SUMMARY_TABLES = "servers contacts sessions"


def _summary(t):
    sessions = col.session_counts(t.processlist)
    return rep.fleet_summary(t.servers, sessions, t.contacts)


@query(SUMMARY, SUMMARY_TABLES)
def fleet_summary(t):
    return _summary(t)


@query(
    f"""
    select '["' || game_id || '-' || location || '","' || location || '","' || dbtype || '","' || contact
      || '",' || servers || ',' || no_sessions || ',' || inactive || '],' as value from ({SUMMARY})""",
    SUMMARY_TABLES,
)
def fleet_summary_rows(t):
    return rep.fleet_summary_rows(_summary(t))


@query(
    """
    select (select count(*) from servers where active <= 1) as servers,
      (select count(*) from gateways) as gateways,
      (select count(*) from servers where active <= 1) + (select count(*) from gateways) as total""",
    "servers gateways",
)
def fleet_totals(t):
    return rep.fleet_totals(t.servers, t.gateways)


SITE_MAP = """
    with a as (select location, dbtype, active from servers where active < 2
      union all select location, 'Jumphost', 1 from gateways),
    r as (select location_iso as country, dbtype, grouping(dbtype) as is_total, min(location_name) as name,
        count(*) as n, sum(case when active <> 1 then 1 else 0 end) as inactive
      from a join locations using (location) group by rollup (location_iso, dbtype)
      having grouping(location_iso) = 0),
    m as (select country, '<u>' || min(name) || '</u></br>' || string_agg(
          case when is_total = 1 then '<b>TOTAL</b>' else dbtype end || ' : ' || n, '</br>'
          order by case when is_total = 1 then 'zzzz' else dbtype end)
        || '</br><font color=blue>Inactive : ' || cast(max(inactive) as bigint) as description,
        case when max(inactive) = 0 then 'green' when max(inactive) >= 4 then 'pink' else 'blue' end
          as marker
      from r group by country)
"""
SITE_TABLES = "servers gateways locations"


@query(SITE_MAP + "select * from m", SITE_TABLES)
def site_map(t):
    return rep.site_map(t.servers, t.gateways, t.locations, pink_from=4)


@query(
    SITE_MAP + """select '["' || country || '","' || description || '","' || marker || '"],' as value
    from m""",
    SITE_TABLES,
)
def site_map_rows(t):
    return rep.site_map_rows(rep.site_map(t.servers, t.gateways, t.locations, pink_from=4))


@query(
    SITE_MAP
    + """
    select case when n_nationkey < 12 then 0 else 2 end as section, cast(n_nationkey as bigint) as line_no,
      n_name as value from nation where n_nationkey <> 12
    union all select 1, 0, '["' || country || '","' || description || '","' || marker || '"],' from m""",
    SITE_TABLES,
)
def report_page(t):
    rows = rep.site_map_rows(rep.site_map(t.servers, t.gateways, t.locations, pink_from=4))
    line = F.when(F.col("n_nationkey") == 12, "<CHANGE>").otherwise(F.col("n_name"))
    template = t.nation.select(F.col("n_nationkey").alias("line_no"), line.alias("line"))
    return sinks.page_lines(rows, template, "<CHANGE>")


@query(
    f"""
    select contact_id, '<TR>' || '<TD>' || game_id || '</TD><TD>' || location || '</TD><TD>' || descr ||
      '</TD><TD>' || ip || '</TD><TD>' || coalesce(file, 'NULL') || '</TD><TD>' ||
      coalesce(failure_reason, 'NULL') || '</TD></TR>' as value from ({ALERT})""",
    "backups hosts",
)
def alert_rows(t):
    alert = hl.backup_alert(t.backups, t.hosts, AS_OF, job_filter("backup_alert"))
    return rep.alert_rows(alert.drop("start", "end", "part_no"))


@query(
    """
    select distinct s.id, s.game_id || '@' || s.location || '-' || s.descr || ':' || s.dbusage as name,
      o.dbschema, s.ip, s.port, s.dbusage
    from servers s join dict_objects o on s.id = o.dbserver_id join contacts c on s.contact_id = c.id
    where s.dbtype in ('MySQL', 'MSSQL') and s.active >= 1 and s.env = 'Live'""",
    "servers dict_objects contacts",
)
def dictionary_targets(t):
    return rep.dictionary_targets(t.servers, t.dict_objects, t.contacts)


MARKUP = """'<p>' || replace(replace(replace(replace(coalesce({column} || ' - ', '') ||
    coalesce({comments}, 'N/A'), chr(10), '<br>'), chr(13), ''), '|', ''), chr(39), '&#39;') || '</p>'"""

LINES = f"""
    with dl as (
      select distinct a.dbserver_id, a.dbschema, coalesce(b.name, a.name) as name,
        coalesce(b.line_num, 0) as line_num,
        {MARKUP.format(column="b.column_name", comments="b.comments")} as comments,
        strftime(coalesce(b.creation_date, a.creation_date), '%Y/%m/%d %H:%M:%S') as created,
        strftime(coalesce(b.modified_date, a.modified_date), '%Y/%m/%d %H:%M:%S') as modified
      from dict_objects a left join dictionary b on a.dbschema = b.dbschema
        and regexp_matches(a.name, '(?i)' || b.name_regexp)
      where a.type = 'table'),
    dr as (
      select dbserver_id, dbschema, name, cast(0 as bigint) as part_no,
        string_agg(comments, '<br>' order by line_num, comments, created, modified) as comments,
        arg_max(created, (line_num, comments, created, modified)) as created,
        arg_max(modified, (line_num, comments, created, modified)) as modified
      from dl group by dbserver_id, dbschema, name)
"""
DICT_TABLES = "dict_objects dictionary"


@query(LINES + "select * from dl", DICT_TABLES)
def dictionary_lines(t):
    return rep.dictionary_lines(t.dict_objects, t.dictionary)


@query(LINES + "select * from dr", DICT_TABLES)
def dictionary_report(t):
    return rep.dictionary_report(t.dict_objects, t.dictionary)


@query(
    LINES
    + """
    select dbserver_id, dbschema, name, part_no, '[''' || name || ''',''' || comments ||
      ''',new Date(''' || created || '''),new Date(''' || modified || ''')],' as value from dr""",
    DICT_TABLES,
)
def dictionary_rows(t):
    return rep.dictionary_rows(rep.dictionary_report(t.dict_objects, t.dictionary))


@query(
    f"""
    select doc_id, {MARKUP.format(column="nullif(lang, 'en')", comments="text")} as markup
    from documents"""
)
def comment_markups(t):
    column = F.nullif("lang", F.lit("en"))
    return t.documents.select("doc_id", comment_markup(column, F.col("text")).alias("markup"))
