import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetwarden.operators import reconcile as rec
from tests.conftest import rows

STATE = "dbserver_id int, user string, n int, note string, run_id string, creation_date timestamp"
STAGED = "dbserver_id int, user string, n int"
KEYS = ["dbserver_id", "user"]


def state(table):
    at = None
    return table(
        [
            (1, "a", 5, "keep", "r1", at), (1, "b", 6, "gone", "r1", at),
            (2, "a", 7, "down", "r1", at), (3, "a", 8, "elsewhere", "r1", at),
        ],
        STATE,
    )


def merged(table, staged, **options):
    return rec.reconcile(
        state(table), table(staged, STAGED), KEYS, ["n"], "r2",
        scope=table([(1,), (2,)], "id int"), protected=table([(2,)], "id int"),
        first_seen="creation_date", as_of="2024-01-31 10:00:00", **options,
    )


def test_changes(table):
    got = merged(table, [(1, "a", None), (1, "c", 9)])
    assert rows(got, "dbserver_id", "user", "n", "note", "run_id", "change") == [
        (1, "a", None, "keep", "r2", "update"),
        (1, "b", 6, "gone", "r1", "delete"),
        (1, "c", 9, None, "r2", "insert"),
        (2, "a", 7, "down", "r1", "keep"),
        (3, "a", 8, "elsewhere", "r1", "keep"),
    ]
    stamps = dict(rows(got, "user", "creation_date"))
    assert str(stamps["c"]) == "2024-01-31 10:00:00" and stamps["b"] is None
    assert rows(rec.change_counts(got)) == [("delete", 1), ("insert", 1), ("keep", 2), ("update", 1)]
    assert rec.new_state(got).columns == state(table).columns
    assert rec.new_state(got).count() == 4


def test_again_is_the_same(table):
    staged = [(1, "a", 1), (1, "c", 9)]
    once = rec.new_state(merged(table, staged))
    again = rec.new_state(
        rec.reconcile(
            once, table(staged, STAGED), KEYS, ["n"], "r2",
            scope=table([(1,), (2,)], "id int"), protected=table([(2,)], "id int"),
            first_seen="creation_date", as_of="2025-01-01",
        )
    )
    assert rows(once) == rows(again)


def test_no_scope_means_every_server(table):
    got = rec.reconcile(state(table), table([(1, "a", 1)], STAGED), KEYS, ["n"], "r2")
    assert rows(rec.change_counts(got)) == [("delete", 3), ("update", 1)]


def test_null_keys_never_match(table):
    null = table([(1, None, 4, "x", "r1", None)], STATE)
    got = rec.reconcile(null, table([(1, None, 5)], STAGED), KEYS, ["n"], "r2")
    assert rows(got, "change") == [("delete",), ("insert",)]
    staged = table([(1, None, 5), (1, "a", 6)], STAGED)
    assert rows(rec.null_key_rows(staged, KEYS), "n") == [(5,)]
    assert rows(rec.stage_dedupe(staged, KEYS, ["n"]), "n") == [(6,)]


def test_protected_servers(table):
    outcomes = table(
        [(1, "r2", True), (2, "r2", False), (3, "r1", False)],
        "dbserver_id int, run_id string, ok boolean",
    )
    assert rows(rec.protected_servers(outcomes, "r2")) == [(2,)]


def test_first_row_per_key_wins_on_a_hot_key(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") < 10000, 1).otherwise(F.col("id")).cast("int").alias("k"),
        (-F.col("id")).alias("line"), F.col("id").cast("string").alias("payload"),
    )
    got = rec.stage_dedupe(hot, ["k"], ["line"])
    assert got.columns == ["k", "line", "payload"]
    assert got.count() == 20001
    assert got.filter("k = 1").collect()[0]["payload"] == "9999"


def test_insert_ignore_keeps_stored_rows(table):
    new = table([(1, "a", 99), (9, "z", 1)], STAGED)
    got = rec.insert_ignore(state(table), new, KEYS, "creation_date", "2024-01-01 00:00:00")
    assert got.count() == 5
    assert dict(rows(got.filter("dbserver_id = 9 or (dbserver_id = 1 and user = 'a')"), "user", "n")) == {
        "a": 5, "z": 1,
    }


def test_update_from_overwrites_with_null(table):
    source = table([(1, "a", None)], STAGED)
    got = rec.update_from(state(table), source, KEYS, ["n"])
    assert rows(got, "dbserver_id", "user", "n")[:2] == [(1, "a", None), (1, "b", 6)]


def test_delete_obsolete(table):
    stored = state(table).withColumn("run_id", F.when(F.col("user") == "b", None).otherwise(F.col("run_id")))
    got = rec.delete_obsolete(
        stored, "r2", scope=table([(1,), (2,)], "id int"), protected=table([(2,)], "id int")
    )
    assert rows(got, "dbserver_id", "user") == [(1, "b"), (2, "a"), (3, "a")]


pairs = st.dictionaries(
    st.tuples(st.integers(1, 4), st.sampled_from("abc")), st.integers(0, 9), max_size=10
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=pairs, new=pairs, scope=st.sets(st.integers(1, 4)), protected=st.sets(st.integers(1, 4)))
def test_reconcile_property(table, old, new, scope, protected):
    current = table([(*k, v, "r1") for k, v in old.items()], "s int, u string, n int, run_id string")
    staged = table([(*k, v) for k, v in new.items()], "s int, u string, n int")
    got = rec.reconcile(
        current, staged, ["s", "u"], ["n"], "r2", server="s",
        scope=table([(s,) for s in scope], "s int"), protected=table([(s,) for s in protected], "s int"),
    )
    want = {}
    for key in old.keys() | new.keys():
        if key in new:
            want[key] = (new[key], "r2", "update" if key in old else "insert")
        else:
            gone = key[0] in scope and key[0] not in protected
            want[key] = (old[key], "r1", "delete" if gone else "keep")
    assert {(r["s"], r["u"]): (r["n"], r["run_id"], r["change"]) for r in got.collect()} == want


def test_missing_payload_column_is_an_error(table):
    with pytest.raises(Exception):
        rec.reconcile(state(table), table([(1, "a", 1)], STAGED), KEYS, ["nope"], "r2").count()
