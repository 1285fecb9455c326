"""Tables in buckets by key, of which a run reads and writes only those that it touches.

A table is a folder with one folder for each version and bucket. Which version of each bucket counts
is said by a manifest, one small row per bucket, that each run writes as a whole after its
data. A run reads the manifest of the run before it and writes folders of its own version only, so a
repeated run replaces its own work, and what a run reads does not grow with the number of runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.sources.sinks import append_rows, read_state, state_path

BUCKETS = 16

# bucket -> table name -> versions whose folders of this bucket make up the table, oldest first
Manifest = dict[int, dict[str, list[int]]]


def bucket_of(*keys: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def write_buckets(rows: DataFrame, base: str, version: int) -> list[int]:
    """Write rows that carry ``_bucket``; returns the buckets that have any."""
    path = state_path(base, version)
    # A bucket's rows come together, but for one with very many, which is split.
    rows.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
    files, folder = _files(rows.sparkSession, path)
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("_bucket="))


def read_buckets(spark: SparkSession, base: str, manifest: Manifest, table: str, buckets: Iterable[int], schema: str) -> DataFrame:
    """Rows of ``table`` in the named buckets, with _bucket: only the folders that count are listed."""
    paths = [f"{state_path(base, v)}/_bucket={b}" for b in buckets for v in manifest.get(b, {}).get(table, ())]
    if not paths:
        return spark.createDataFrame([], f"{schema}, _bucket int")
    parts = spark.read.option("basePath", base).schema(f"{schema}, version bigint, _bucket int").parquet(*paths)
    return parts.drop("version")


def write_manifest(spark: SparkSession, base: str, version: int, manifest: Manifest) -> None:
    rows = [(b, t, v) for b, tables in manifest.items() for t, versions in tables.items() for v in versions]
    append_rows(spark.createDataFrame(rows, "bucket int, name string, v bigint").coalesce(1), f"{base}/manifest", version)


def read_manifest(spark: SparkSession, base: str, version: int) -> Manifest:
    """The manifest of a run: at most BUCKETS entries, each as long as the runs since its bucket was last rewritten."""
    out: Manifest = {}
    for r in read_state(spark, f"{base}/manifest", version).orderBy("v").collect():
        out.setdefault(r["bucket"], {}).setdefault(r["name"], []).append(r["v"])
    return out


def replaced(manifest: Manifest, table: str, version: int, touched: Iterable[int], written: Iterable[int]) -> None:
    """In the touched buckets the table is now what ``version`` wrote, nothing where it wrote nothing."""
    written = set(written)
    for b in touched:
        manifest.setdefault(b, {})[table] = [version] if b in written else []


def added(manifest: Manifest, table: str, version: int, written: Iterable[int]) -> None:
    """``version`` adds rows to the table in the buckets that it wrote."""
    for b in written:
        manifest.setdefault(b, {}).setdefault(table, []).append(version)
