"""Age limits on tables that are partitioned by time on disk: planned from the listing of their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.times import midnight, time_literal
from fleetwarden.session import stored
from fleetwarden.sources.readers import read_listing


def _bounds(value: Column) -> tuple[Column, Column]:
    """First day of a partition value (a year, month or day as yyyy, yyyy-MM, yyyy-MM-dd) and of the next."""
    size = F.length(value)
    start = F.when(size == 4, F.concat(value, F.lit("-01-01"))).when(size == 7, F.concat(value, F.lit("-01"))).otherwise(value)
    start = start.try_cast("date")
    after = F.when(size == 4, F.add_months(start, 12)).when(size == 7, F.add_months(start, 1)).otherwise(F.date_add(start, 1))
    return start, after


def retention_folders(listing: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    """(partition, files, bytes, action) of a table partitioned by ``column``, from its files (path, length).

    ``drop``: all of the partition is older than ``days``; ``trim``: the limit lies within it; ``keep``: the
    rest, partitions whose value is no date included. No data file is read.
    """
    value = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    found = listing.select(value.alias("partition"), "length").filter("partition <> ''")
    found = found.groupBy("partition").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    start, after = _bounds(F.col("partition"))
    limit = F.lit(midnight(as_of, -days).date().isoformat()).cast("date")
    action = F.when(after <= limit, "drop").when(start < limit, "trim").otherwise("keep")
    return found.withColumn("action", action)


def apply_retention(spark: SparkSession, path: str, column: str, time: str, as_of: str, days: int) -> DataFrame:
    """Drop and trim the partitions of the table under ``path``; returns the plan that was followed.

    Folders that are too old go as a whole. Of the partition that the limit cuts, the rows to keep are
    written beside it first and then take its place; no other data file is read. A repeated run finds less to
    do and ends alike. The plan that reaches the driver has one row per partition.
    """
    plan = stored(retention_folders(read_listing(spark, path, "*.parquet"), column, as_of, days), "retention")
    todo = {r["partition"]: r["action"] for r in plan.filter("action <> 'keep'").collect()}
    trims = sorted(p for p, action in todo.items() if action == "trim")
    empty = set()
    if trims:
        folders = [f"{path.rstrip('/')}/{column}={p}" for p in trims]
        rows = spark.read.option("basePath", path).parquet(*folders).withColumn(column, F.col(column).cast("string"))
        kept = stored(rows.filter(F.col(time) >= time_literal(rows, time, midnight(as_of, -days))), "trimmed")
        left = {r[0] for r in kept.select(column).distinct().collect()}
        empty = set(trims) - left
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(path)
    for partition, action in todo.items():
        if action == "drop" or partition in empty:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={partition}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return plan
