import datetime as dt
import re

from pyspark.sql import functions as F

from fleetwarden import schemas
from fleetwarden.functions.text import js_row, js_text, required_literals
from fleetwarden.operators import reports as rep
from fleetwarden.sources import sinks
from tests.conftest import rows
from tests.test_inventory import fleet

D1, D2, D3 = (dt.datetime(2024, 1, n, 1, 2, 3) for n in (1, 2, 3))


def test_fleet_summary_and_totals(table):
    servers, gateways, contacts = fleet(table)
    sessions = table([(1, 5), (1, 2), (3, 1), (99, 4)], "dbserver_id int, session_count int")
    got = rep.fleet_summary(servers, sessions, contacts)
    assert rows(got, "game_id", "location", "dbtype", "contact", "servers", "no_sessions", "inactive") == [
        ("G", "SG", "MySQL", "Ann", 2, 1, 0),
        ("G", "TH", "MariaDB", "Bo", 1, 0, 0), ("H", "VN", "MySQL", "Bo", 1, 1, 1),
        ("H", "XX", "MariaDB", "Bo", 1, 1, 0),
    ]
    assert '["G-SG","SG","MySQL","Ann",2,1,0],' in [r[0] for r in rep.fleet_summary_rows(got).collect()]
    assert rows(rep.fleet_totals(servers, gateways)) == [(6, 3, 9)]


def test_site_map(table):
    servers, gateways, _ = fleet(table)
    locations = table([("SG", "SG", "Singapore"), ("TH", "TH", "Thailand"), ("VN", "VN", "Viet Nam")],
                      schemas.LOCATIONS)
    got = {r["country"]: r for r in rep.site_map(servers, gateways, locations).collect()}
    assert set(got) == {"SG", "TH", "VN"}
    assert got["SG"]["description"] == (
        "<u>Singapore</u></br>Jumphost : 2</br>MySQL : 2</br><b>TOTAL</b> : 4"
        "</br><font color=blue>Inactive : 0"
    )
    assert got["SG"]["marker"] == "green" and got["VN"]["marker"] == "blue"
    assert "<b>TOTAL</b> : 2" in got["VN"]["description"]
    pink = rep.site_map(servers, gateways, locations, pink_from=1)
    assert dict(rows(pink, "country", "marker"))["VN"] == "pink"


def test_site_map_keeps_a_kind_without_name_apart_from_the_total(table):
    servers = table([("SG", None, 1), ("SG", "MySQL", 1)], "location string, dbtype string, active int")
    gateways = table([], "location string")
    locations = table([("SG", "SG", "Singapore")], schemas.LOCATIONS)
    text = rep.site_map(servers, gateways, locations).collect()[0]["description"]
    assert "MySQL : 1</br><b>TOTAL</b> : 2" in text


OBJECTS = [
    (1, "s", "table", "log_001"), (1, "s", "table", "LOG_002"), (1, "s", "table", "plain"),
    (1, "s", "view", "log_003"), (2, "s", "table", "both_a"), (1, "t", "table", "log_001"),
]
DICTIONARY = [
    ("s", "log_N", "^log_[0-9]+$", None, "it's a|\r\nlog", 1, D2, D2),
    ("s", "log_N", "^log_[0-9]+$", "id", None, 2, D2, D3),
    ("s", "log_N", "^log_[0-9]+$", "at", "time", 3, D2, D3),
    ("s", "both_1", "both", None, "first", 1, None, D2),
    ("S", "both_2", "_A$", None, "second", 1, D2, None),
]


def dictionary(table):
    objects = table(
        [(*o[:4], 0, None, None, D1, D1) for o in OBJECTS], schemas.OBJECTS
    )
    return objects, table(DICTIONARY, schemas.DICTIONARY)


def test_dictionary_report(table):
    objects, entries = dictionary(table)
    got = rep.dictionary_report(objects, entries)
    t1, t2, t3 = "2024/01/01 01:02:03", "2024/01/02 01:02:03", "2024/01/03 01:02:03"
    assert rows(got, "dbserver_id", "dbschema", "name", "comments", "created", "modified") == [
        (1, "s", "log_N",
         "<p>it&#39;s a<br>log</p><br><p>id - N/A</p><br><p>at - time</p>", t2, t3),
        (1, "s", "plain", "<p>N/A</p>", t1, t1),
        (1, "t", "log_001", "<p>N/A</p>", t1, t1),
        (2, "s", "both_1", "<p>first</p>", t1, t2),
        (2, "s", "both_2", "<p>second</p>", t2, t1),
    ]
    value = rep.dictionary_rows(got).filter("name = 'plain'").collect()[0]["value"]
    assert value == f"['plain','<p>N/A</p>',new Date('{t1}'),new Date('{t1}')],"


PATTERNS = [
    "^log_[0-9]+$", "^log", "log", "^lo*g", "^lo?", "^lo{0,1}", "^log$|x", "^(log)", "^LOG\\_x", "^", "^é", "é_log",
    "a(b|c)d", "(ab|cd)+", "x[[:digit:]]y_z", "[]a]b", "[^]x]log", "a\\|b|cd", "(?x) l o g", "(?i)LOG", "\\Qa.b\\E", "\\x41bc",
    "lo+g", "lo+?g_", "a.b.cde", "[[:<:]]log[[:>:]]", "((a)|(b(c|d)))_x", "log|", "K_log", "a{2}bc", "\\d+_end", "tab\\.x", "(a|b)(c|d)",
]
NAMES = [
    "log_1", "log", "LOG_x", "lg", "l", "x", "élog", "lo", "abd", "acd", "abab", "x7y_z", "ab", "]b", "xlog", "a|b", "cd", "É_LOG", "a.b",
    "Abc", "loooog_", "a1b2cde", "my log x", "bc_x", "\u212a_log", "k_log", "aabc", "12_END", "tab.x", "tabox", "bd",
]


def test_required_literals_never_lose_a_match(table):
    got = table([(p,) for p in PATTERNS], "p string").select("p", required_literals(rep.jvm_pattern(F.col("p"))).alias("l"))
    found = dict((r["p"], r["l"]) for r in got.collect())
    assert found["^log_[0-9]+$"] == ["log_"] and found["^LOG\\_x"] == ["log"] and found["log"] == ["log"]
    assert sorted(found["a\\|b|cd"]) == ["b", "cd"] and found["lo+g"] == ["lo"] and found["a.b.cde"] == ["cde"]
    assert found["x[[:digit:]]y_z"] == ["y_z"] and found["\\d+_end"] == ["_end"]
    for p in ("^", "(ab|cd)+", "log|", "(?x) l o g", "\\Qa.b\\E", "\\x41bc", "[]a]b", "(a|b)(c|d)"):
        assert found[p] is None, p
    names = table([(n,) for n in NAMES], "n string")
    forms = table([(p,) for p in PATTERNS], "p string").select("p", rep.jvm_pattern(F.col("p")).alias("form"))
    for r in names.join(forms, F.expr("n rlike concat('(?i)', form)")).collect():
        assert found[r["p"]] is None or any(x in r["n"].lower() for x in found[r["p"]]), r


def test_patterns_meet_all_names_they_match(table):
    objects = table(
        [(1 + i % 2, "sS"[i % 2] if n != "cd" else "t", "table", n, 0, None, None, D1, D1) for i, n in enumerate(NAMES)],
        schemas.OBJECTS,
    )
    entries = table([("s", f"e{i}", p, None, None, 1, None, None) for i, p in enumerate(PATTERNS)], schemas.DICTIONARY)
    got = rep.dictionary_lines(objects, entries).select("dbserver_id", "name").distinct()
    all_pairs = objects.filter("dbschema <> 't'").select("dbserver_id", F.col("name").alias("n")).join(
        entries.select("name", rep.jvm_pattern(F.col("name_regexp")).alias("form")), F.expr("n rlike concat('(?i)', form)")
    )
    want = {tuple(r) for r in all_pairs.select("dbserver_id", "name").collect()}
    assert {tuple(r) for r in got.filter("name like 'e%'").collect()} - {(1, "élog"), (2, "élog")} == want


def test_many_unanchored_patterns_are_not_paired_with_all_names(spark):
    names = spark.range(20_000).select(
        F.lit("s").alias("_schema"), F.concat(F.lit("t_"), F.col("id").cast("string"), F.lit("_part")).alias("_table")
    )
    entries = spark.range(2_000).select(
        F.lit("s").alias("_entry_schema"), F.concat(F.lit("_"), (F.col("id") + 3000).cast("string"), F.lit("_.+t$")).alias("name_regexp")
    )
    got = rep.pattern_candidates(names, entries)
    assert got.count() == 2_000
    free = spark.createDataFrame([("s", "^.+9_.*$")], "_entry_schema string, name_regexp string")
    assert rep.pattern_candidates(names, entries.unionByName(free)).count() == 2_000 + names.filter("_table like '%9_part'").count()


def test_bad_patterns_are_found(table):
    _, entries = dictionary(table)
    bad = table([("s", "x", "([", None, None, 1, None, None)], schemas.DICTIONARY)
    good, rejected = rep.usable_entries(entries.unionByName(bad))
    assert rows(rejected, "name_regexp") == [("([",)] and good.count() == entries.count()


def test_patterns_are_tried_in_the_tasks(table, monkeypatch):
    entries = table([("([",), ("a",), (None,), ("[[:digit:]]+",), ("*",), ("([",)], "name_regexp string")
    monkeypatch.setattr(type(entries), "toLocalIterator", None)
    good, rejected = rep.usable_entries(entries)
    assert rows(rejected) == [("([",), ("([",), ("*",)] and rows(good) == [(None,), ("[[:digit:]]+",), ("a",)]


def test_patterns_of_the_databases_dialect(table):
    patterns = ["^t[[:digit:]]+$", "[[:<:]]log[[:>:]]", "^[[:alpha:]_]+$"]
    names = table([("t12",), ("a log b",), ("blog",), ("Ab_c",)], "name string")
    forms = table([(p,) for p in patterns], "p string").select("p", rep.jvm_pattern(F.col("p")).alias("form"))
    got = names.join(forms, F.expr("name rlike form")).select("p", "name")
    assert rows(got) == sorted(
        [(patterns[0], "t12"), (patterns[1], "a log b"), (patterns[2], "Ab_c"), (patterns[2], "blog")]
    )


def test_null_cells_keep_their_place(table):
    got = table([(None, "x", None)], "a string, b string, c int").select(js_row(js_text(F.col("a")), js_text(F.col("b")), F.col("c")).alias("r"))
    assert got.first()["r"] == '[null,"x",null],'


def test_dictionary_targets(table):
    servers, _, contacts = fleet(table)
    objects = table([(1, "a"), (1, "a"), (1, "b"), (4, "a"), (7, "c")], "dbserver_id int, dbschema string")
    assert rows(rep.dictionary_targets(servers, objects, contacts), "id", "dbschema") == [
        (1, "a"), (1, "b"), (7, "c"),
    ]


def test_rows_and_page(table, tmp_path, spark):
    alerts = table([(7, "a<b", None)], "contact_id int, file string, reason string")
    assert rows(rep.alert_rows(alerts)) == [(7, "<TR><TD>a&lt;b</TD><TD>NULL</TD></TR>")]
    assert rows(sinks.json_rows(alerts)) == [('{"contact_id":7,"file":"a<b"}',)]
    template = table([(1, "<html>"), (2, "<CHANGE>"), (3, "</html>")], "line_no int, line string")
    page = sinks.page_lines(table([("r2",), ("r1",)], "value string"), template, "<CHANGE>")
    sinks.write_page(page, str(tmp_path / "page"))
    parts = sorted((tmp_path / "page").glob("part-*"))
    assert "".join(p.read_text() for p in parts).split() == ["<html>", "r1", "r2", "</html>"]
    try:
        sinks.page_lines(table([("r",)], "value string"), template, "<NONE>")
        raise AssertionError("a template without mark was accepted")
    except ValueError:
        pass
