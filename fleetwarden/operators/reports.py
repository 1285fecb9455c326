"""Reports: fleet summary and totals, site map, data dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.text import comment_markup, html_row, js_row, js_text, required_literals
from fleetwarden.functions.times import REPORT_TIME_FORMAT
from fleetwarden.operators.concat import MAX_CELL_BYTES, ordered_concat
from fleetwarden.operators.grams import gram_hits, gram_index
from fleetwarden.operators.inventory import display_name, job_filter
from fleetwarden.session import stored

# Labels, separators and colours of the site map.
GATEWAY_TYPE = "Jumphost"
TOTAL_LABEL = "<b>TOTAL</b>"
LINE_BREAK = "</br>"
TOTAL_SORTS_AS = "zzzz"
PINK_FROM = 10
# The database's word marks and POSIX classes, and what the JVM calls them.
WORD_MARKS = {"[[:<:]]": r"\b(?=\w)", "[[:>:]]": r"(?<=\w)\b"}
POSIX_CLASSES = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}", "graph": r"\p{Graph}", "lower": r"\p{Lower}", "print": r"\p{Print}",
    "punct": r"\p{Punct}", "space": r"\s", "upper": r"\p{Upper}", "xdigit": r"\p{XDigit}",
}


def fleet_summary(servers: DataFrame, sessions: DataFrame, contacts: DataFrame) -> DataFrame:
    """Servers, servers without sessions and inactive servers per (game, location, kind, contact).

    Sessions are summed per server before the join. Spellings of a kind that differ in case are
    one kind.
    """
    connected = sessions.groupBy(F.col("dbserver_id").alias("id")).agg(
        F.sum("session_count").alias("sessions")
    )
    people = contacts.select(F.col("id").alias("contact_id"), F.col("name").alias("contact"))
    return (
        servers.filter(job_filter("fleet"))
        .select("id", "game_id", "location", "dbtype", "active", "contact_id")
        .join(people, "contact_id", "inner")
        .join(connected, "id", "left")
        .groupBy("game_id", "location", F.lower("dbtype").alias("_kind"), "contact")
        .agg(
            F.min("dbtype").alias("dbtype"),
            F.count("*").alias("servers"),
            F.count_if(F.col("sessions").isNull()).alias("no_sessions"),
            F.count_if(F.col("active") != 1).alias("inactive"),
        )
        .select("game_id", "location", "dbtype", "contact", "servers", "no_sessions", "inactive")
    )


def fleet_totals(servers: DataFrame, gateways: DataFrame) -> DataFrame:
    """Servers, gateways and their total, counted in one aggregation."""
    rows = servers.filter(job_filter("fleet")).select(F.lit(1).alias("server")).unionByName(
        gateways.select(F.lit(0).alias("server"))
    )
    return rows.agg(
        F.count_if(F.col("server") == 1).alias("servers"),
        F.count_if(F.col("server") == 0).alias("gateways"),
        F.count("*").alias("total"),
    )


def site_map(
    servers: DataFrame, gateways: DataFrame, locations: DataFrame, pink_from: int = PINK_FROM
) -> DataFrame:
    """Per country: kinds with counts and the total, inactive count, and a colour.

    Servers are counted per (site, kind) before the join and the rollup. Spellings of a kind that
    differ in case are one kind.
    Totals are told by the rollup's grouping, not by a NULL kind; sites of unknown location have
    no country and drop out, as does a NULL ``active``.
    """
    places = locations.select("location", F.col("location_iso").alias("country"), "location_name")
    rows = servers.filter(job_filter("site_map")).select("location", "dbtype", "active").unionByName(
        gateways.select("location", F.lit(GATEWAY_TYPE).alias("dbtype"), F.lit(1).alias("active"))
    )
    per_site = rows.groupBy("location", F.lower("dbtype").alias("_kind")).agg(
        F.min("dbtype").alias("dbtype"),
        F.count("*").alias("n"),
        F.count_if(F.col("active") != 1).alias("inactive"),
    )
    counts = (
        per_site.join(places, "location", "inner")
        .filter(F.col("country").isNotNull())
        .rollup("country", "_kind")
        .agg(
            F.min("dbtype").alias("dbtype"),
            F.grouping("_kind").alias("is_total"),
            F.grouping("country").alias("is_grand_total"),
            F.sum("n").alias("n"),
            F.sum("inactive").alias("inactive"),
            F.min("location_name").alias("location_name"),
        )
        .filter(F.col("is_grand_total") == 0)
    )
    label = F.when(F.col("is_total") == 1, TOTAL_LABEL).otherwise(F.col("dbtype"))
    counts = counts.withColumn(
        "_entry", F.concat(label, F.lit(" : "), F.col("n").cast("string"))
    ).withColumn("_sort", F.when(F.col("is_total") == 1, TOTAL_SORTS_AS).otherwise(F.col("dbtype")))
    # One entry per kind of database: the list per country is short whatever the data size.
    entries = F.expr(f"listagg(_entry, '{LINE_BREAK}') within group (order by _sort)")
    inactive = F.max("inactive")
    return counts.groupBy("country").agg(
        F.concat(
            F.lit("<u>"), F.min("location_name"), F.lit("</u>" + LINE_BREAK), entries,
            F.lit(LINE_BREAK + "<font color=blue>Inactive : "), inactive.cast("string"),
        ).alias("description"),
        F.when(inactive == 0, "green").when(inactive >= pink_from, "pink").otherwise("blue").alias("marker"),
    )


def dictionary_targets(servers: DataFrame, objects: DataFrame, contacts: DataFrame) -> DataFrame:
    """Distinct live (server, schema) pairs that have objects and a contact, ordered by ip.

    Objects are reduced to (server, schema) before the join.
    """
    schemas = objects.select(F.col("dbserver_id").alias("id"), "dbschema").distinct()
    people = contacts.select(F.col("id").alias("contact_id"))
    return (
        servers.filter(job_filter("dictionary"))
        .withColumn("name", display_name())
        .join(people, "contact_id", "left_semi")
        .join(schemas, "id", "inner")
        .select("id", "name", "dbschema", "ip", "port", "dbusage")
        .orderBy("ip", "id", "dbschema")
    )


def jvm_pattern(pattern: Column) -> Column:
    """A pattern of the database's dialect for the JVM: POSIX classes and word marks."""
    for mark, form in WORD_MARKS.items():
        pattern = F.replace(pattern, F.lit(mark), F.lit(form))
    for name, form in POSIX_CLASSES.items():
        pattern = F.replace(pattern, F.lit(f"[:{name}:]"), F.lit(form))
    return pattern


def usable_entries(dictionary: DataFrame, column: str = "name_regexp") -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) entries by whether the JVM takes their pattern; NULL is usable.

    The JVM of each task tries the patterns of its own rows.
    """
    form = jvm_pattern(F.col(column))
    tried = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), form)
    fits = F.col(column).isNull() | tried.isNotNull()
    return dictionary.filter(fits), dictionary.filter(~fits)


def pattern_index(dictionary: DataFrame, column: str = "name_regexp") -> DataFrame:
    """(``column``, literals) of the distinct patterns; ``literals`` as :func:`required_literals` finds them.

    Patterns with NULL there are tried on every name of their schema, and worth reporting.
    """
    patterns = dictionary.select(column).filter(F.col(column).isNotNull()).distinct()
    return patterns.withColumn("literals", required_literals(jvm_pattern(F.col(column))))


def pattern_candidates(names: DataFrame, entries: DataFrame) -> DataFrame:
    """``entries`` with the _schema and _table of each name that may match: all pairs that can, and few others.

    ``names`` (_schema, _table) and ``entries`` (_entry_schema, name_regexp, ...), each once. Names meet a
    pattern's literal over an index of grams, whatever the schema; only patterns without literal meet
    all names of their schema.
    """
    known = entries.filter(F.col("name_regexp").isNotNull())
    known = stored(known.withColumn("_literals", required_literals(jvm_pattern(F.col("name_regexp")))), "patterns")
    spelled = names.select("_schema", "_table", F.lower("_table").alias("_lower"))
    alternatives = known.withColumn("_literal", F.explode("_literals"))
    index = gram_index(alternatives, "_literal")
    hits = gram_hits(spelled, "_lower", index).withColumnRenamed("_gram", "_piece")
    holds = (F.col("_piece") == F.col("_gram")) & F.contains("_lower", "_literal")
    held = hits.join(index, holds, "inner").select("_lower", "_literal").distinct()
    same_schema = F.col("_schema") == F.col("_entry_schema")
    met = spelled.join(held, "_lower", "inner").join(
        alternatives.withColumnRenamed("_literal", "_any"), same_schema & (F.col("_literal") == F.col("_any")), "inner"
    )
    columns = ["_schema", "_table", *entries.columns]
    # A name may hold several alternatives of one pattern.
    indexed = met.select(*columns).dropDuplicates(["_schema", "_table", "name_regexp"])
    free = names.join(known.filter("_literals is null"), same_schema, "inner")
    return indexed.unionByName(free.select(*columns))


def dictionary_lines(objects: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary lines of every table: (dbserver_id, dbschema, name, line_num, comments, dates).

    A table matches the dictionary entries of its schema whose pattern is found in its name, both
    ignoring case; a table without entry has one ``N/A`` line. Tables that match the same entry
    collapse to the entry's name. Patterns are tried against distinct table names only, and an
    entry of many lines is tried once.
    """
    tables = objects.filter(F.col("type") == "table").select(
        "dbserver_id", "dbschema", "name", "creation_date", "modified_date"
    )
    tables = tables.withColumn("_schema", F.lower("dbschema")).withColumnRenamed("name", "_table")
    names = tables.select("_schema", "_table").distinct()
    entries = dictionary.groupBy(F.lower("dbschema").alias("_entry_schema"), "name_regexp").agg(
        F.bool_or(F.col("creation_date").isNull()).alias("_undated"),
        F.bool_or(F.col("modified_date").isNull()).alias("_unmodified"),
    )
    matched = (
        pattern_candidates(names, entries)
        .withColumn("_form", F.concat(F.lit("(?i)"), jvm_pattern(F.col("name_regexp"))))
        .filter(F.expr("_table rlike _form"))
        .select("_schema", "_table", "name_regexp", "_undated", "_unmodified")
    )
    # A family of tables collapses to its entry here, before the entry's lines are attached; a
    # table's own name and dates are carried on only where the report shows them.
    free = F.col("name_regexp").isNull()
    hits = (
        tables.join(matched, ["_schema", "_table"], "left")
        .select(
            "dbserver_id",
            "dbschema",
            "_schema",
            "name_regexp",
            F.when(free, F.col("_table")).alias("_table"),
            F.when(free | F.col("_undated"), F.col("creation_date")).alias("creation_date"),
            F.when(free | F.col("_unmodified"), F.col("modified_date")).alias("modified_date"),
        )
        .distinct()
    )
    lines = dictionary.select(
        F.lower("dbschema").alias("_schema"), "name_regexp", F.col("name").alias("entry_name"), "column_name", "comments",
        "line_num", F.col("creation_date").alias("entry_created"),
        F.col("modified_date").alias("entry_modified"),
    )
    found = hits.join(lines, ["_schema", "name_regexp"], "left")

    def day(entry: str, table: str) -> Column:
        return F.date_format(F.coalesce(entry, table), REPORT_TIME_FORMAT)

    return found.select(
        "dbserver_id",
        "dbschema",
        F.coalesce("entry_name", "_table").alias("name"),
        F.coalesce("line_num", F.lit(0)).alias("line_num"),
        comment_markup(F.col("column_name"), F.col("comments")).alias("comments"),
        day("entry_created", "creation_date").alias("created"),
        day("entry_modified", "modified_date").alias("modified"),
    ).distinct()


def dictionary_report(
    objects: DataFrame, dictionary: DataFrame, max_cell_bytes: int = MAX_CELL_BYTES
) -> DataFrame:
    """One row per documented name: its lines in order, and the dates of its last line."""
    lines = dictionary_lines(objects, dictionary)
    keys = ["dbserver_id", "dbschema", "name"]
    order = ["line_num", "comments", "created", "modified"]
    return ordered_concat(
        lines, keys, F.col("comments"), [F.col(c) for c in order], "<br>", out="comments",
        max_cell_bytes=max_cell_bytes, last=["created", "modified"],
    )


def fleet_summary_rows(summary: DataFrame) -> DataFrame:
    """The fleet summary as script array rows."""
    site = F.concat("game_id", F.lit("-"), "location")
    cells = [js_text(site), *[js_text(F.col(c)) for c in ("location", "dbtype", "contact")]]
    numbers = [F.col(c).cast("string") for c in ("servers", "no_sessions", "inactive")]
    return summary.select(js_row(*cells, *numbers).alias("value"))


def site_map_rows(sites: DataFrame) -> DataFrame:
    return sites.select(
        js_row(*[js_text(F.col(c)) for c in ("country", "description", "marker")]).alias("value")
    )


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alert rows as HTML table rows, one text line each, with the contact they go to."""
    cells = [F.col(c) for c in alerts.columns if c != "contact_id"]
    return alerts.select("contact_id", html_row(*cells).alias("value"))


def dictionary_rows(report: DataFrame) -> DataFrame:
    """The dictionary report as script array rows with date objects."""
    def date(c: str) -> Column:
        return F.concat(F.lit("new Date('"), c, F.lit("')"))

    def text(c: str) -> Column:
        return F.concat(F.lit("'"), c, F.lit("'"))

    row = js_row(text("name"), text("comments"), date("created"), date("modified"))
    return report.select("dbserver_id", "dbschema", "name", "part_no", row.alias("value"))
