"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "fleetwarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC pinned.

    Skewed joins are split even where that costs another shuffle. Sizes that depend on the
    cluster (shuffle partitions, memory) are left to spark-defaults or ``conf``; AQE coalesces
    small shuffle partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Where that setting is absent a local temporary folder serves, but only in local mode:
    on a cluster a machine-local path would be lost with the machine.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="fleetwarden-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``rows`` to the shared folder, or to one inside it, and read them back.

    This cuts the lineage, survives lost executors, and gives Spark the true size, by which it
    decides on broadcasts.
    """
    path = f"{folder}/{name}" if folder else scratch_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that no later job reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block remove their shuffle files as they end.

    Otherwise the files of all queries stay until the driver happens to collect its garbage. For
    queries whose rows are stored: one that runs again shuffles again.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
