"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from fleetwarden.plans.registry import ORACLES, QUERIES
from tests.compare import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    _, faults = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert not faults


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_no_nested_loops(spark, sf_dir):
    """No query pairs every row with every other."""
    for name, build in QUERIES.items():
        plan = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct"):
            assert bad not in plan, (name, bad)
