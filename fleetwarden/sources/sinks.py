"""Writers: request results, report rows and pages, captured files, versioned state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.sources.readers import PACKED


def write_csv(rows: DataFrame, path: str, by: str | None = None) -> None:
    """CSV with a header; values are quoted where needed. ``by`` gives one folder per value."""
    writer = rows.write.mode("overwrite").option("header", "true")
    (writer.partitionBy(by) if by else writer).csv(path)


def json_rows(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct(*report.columns)).alias("value"))


def page_lines(rows: DataFrame, template: DataFrame, mark: str) -> DataFrame:
    """Template lines with the report rows in place of the line that holds ``mark``.

    rows: (value); template: (line_no, line) with one marked line. Result: (section, line_no,
    value), to be sorted by its first two columns; rows keep the order of their text.
    """
    marked = F.col("line").contains(mark)
    at = template.filter(marked).agg(F.min("line_no")).first()[0]
    if at is None:
        raise ValueError(f"the template has no line with {mark!r}")
    frame = template.filter(~marked).select(
        F.when(F.col("line_no") < at, 0).otherwise(2).alias("section"),
        F.col("line_no").cast("bigint").alias("line_no"),
        F.col("line").alias("value"),
    )
    body = rows.select(F.lit(1).alias("section"), F.lit(0).cast("bigint").alias("line_no"), "value")
    return frame.unionByName(body)


def write_page(page: DataFrame, path: str) -> None:
    """Write the lines of a page in order; file names sort as the lines do."""
    page.orderBy("section", "line_no", "value").select("value").write.mode("overwrite").text(path)


def write_packed(rows: DataFrame, path: str) -> str:
    """Captured files, as many as there may be, in a few files; returns the folder, for ``read_*``.

    rows: (file, value), where a value is one or more whole lines or records of a file, without its last
    line end, and NULL an empty line. One file per server costs the same time for each server, however
    little it holds; here the number of files is that of the partitions of ``rows``. No row is moved.
    ``place`` keeps the order of a file's rows.
    """
    folder = f"{path.rstrip('/')}{PACKED}"
    value = F.coalesce("value", F.lit(""))
    rows.select(
        "file",
        F.monotonically_increasing_id().alias("place"),
        (F.octet_length(value) + 1).cast("bigint").alias("length"),
        F.concat(value, F.lit("\n")).alias("text"),
    ).write.parquet(folder)
    return folder


def state_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/version={version:012d}"


def write_state(state: DataFrame, base: str, version: int) -> None:
    """Store a version of a state table in its own folder.

    The version being read is never the one written, and a run that is repeated after a failure
    replaces its own folder only.
    """
    state.write.mode("overwrite").parquet(state_path(base, version))


def read_state(spark: SparkSession, base: str, version: int) -> DataFrame:
    return spark.read.parquet(state_path(base, version))


def append_rows(rows: DataFrame, path: str, version: int) -> None:
    """Append a run's rows to a table kept as one folder per run; a repeated run appends once."""
    write_state(rows, path, version)


def read_appended(spark: SparkSession, path: str, up_to: int) -> DataFrame:
    """The rows of all runs up to ``up_to``; folders of later runs are pruned."""
    return spark.read.parquet(path).filter(F.col("version") <= up_to).drop("version")


def stored_versions(spark: SparkSession, base: str) -> list[int]:
    """The versions of a state table that exist, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("version="))


def retire_versions(spark: SparkSession, base: str, versions: list[int]) -> list[int]:
    """Remove the listed versions of a state table, but never the newest one; returns what went.

    The list is the caller's, e.g. all but the last few of :func:`stored_versions`.
    """
    kept = stored_versions(spark, base)
    gone = [v for v in versions if v in kept[:-1]]
    for version in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(state_path(base, version))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
