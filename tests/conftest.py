from __future__ import annotations

import os

import pytest

from fleetwarden.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            # Plans name whole filters; by default each is cut after 100 characters, and identifiers grow.
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def table(spark):
    """Small table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])
