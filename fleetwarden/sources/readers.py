"""Readers: bulk-load files, logs, status records, reports, listings, sheets, databases.

Each ``read_*`` opens files; the ``parse_*`` it uses works on a DataFrame with a ``line`` column,
so the same code serves text that is already in a table or a stream.

A folder that ends in PACKED holds many captured files in a few (:func:`sinks.write_packed`); lines,
records, reports and listings are read from it as from the files themselves, and their ``file`` or
``path`` is that of the captured file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.functions.text import client_null, decode_field

# Fixed value: the mark before each record of vertical client output.
RECORD_MARK = "*************************** "
# The end of a folder's name that tells captured files packed into a few.
PACKED = ".packed"
_PACKED_SCHEMA = "file string, place bigint, length bigint, text string"
# Where the client's output of each object type holds the definition.
DEFINITION_COLUMN = {"table": 2, "view": 2, "event": 4, "trigger": 3, "procedure": 3}


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def parse_tsv(
    lines: DataFrame, schema: str | T.StructType, line: str = "line", escapes: bool = True, **constants
) -> DataFrame:
    """Cut tab-separated lines into typed columns; ``constants`` are added to every row.

    Missing trailing fields are NULL, surplus ones are ignored, and a field that does not fit its
    type is NULL, as a lenient bulk load has it. Other columns of ``lines`` are kept in front.
    """
    field = F.split(F.col(line), "\t")
    columns = []
    for i, f in enumerate(_schema(schema).fields):
        value = decode_field(F.get(field, F.lit(i)), escapes)
        columns.append(value.try_cast(f.dataType).alias(f.name))
    kept = [c for c in lines.columns if c != line]
    return lines.select(*kept, *columns, *[F.lit(v).alias(k) for k, v in constants.items()])


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    escapes: bool = True,
    numbered: bool = False,
    **constants,
) -> DataFrame:
    """A headerless bulk-load file. Spark's CSV reader is not used: it would take quotes as
    quoting, leave the escapes undecoded and read an empty field as NULL. ``numbered`` adds
    (file, line_no), the order in which the first row of a key is chosen."""
    if numbered:
        lines = read_lines(spark, path)
    else:
        lines = spark.read.text(path).withColumnRenamed("value", "line")
    return parse_tsv(lines, schema, escapes=escapes, **constants)


def _packed(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame | None:
    """The rows of packed captured files; None where ``path`` holds the files themselves."""
    if not path.rstrip("/").endswith(PACKED):
        return None
    rows = spark.read.schema(_PACKED_SCHEMA).parquet(path)
    return rows.filter(F.regexp_extract("file", "[^/]*$", 0).rlike(_glob_pattern(glob))) if glob else rows


def _glob_pattern(glob: str) -> str:
    """A file name pattern of ``*`` and ``?`` as a JVM pattern."""
    if set(glob) & set("[]{}\\"):
        raise ValueError(f"packed files are chosen by * and ? only, not by {glob!r}")
    wild = {"*": ".*", "?": "."}
    return "(?s)^" + "".join(wild.get(c, rf"\Q{c}\E") for c in glob) + "$"


def _packed_lines(rows: DataFrame) -> DataFrame:
    """(file, line_no, line) of packed rows; a line ends as in a text file, by CR, LF or both."""
    pieces = F.split("text", "\r\n|\r|\n")  # the last one, after the last line end, is no line
    rows = rows.select("file", "place", F.posexplode(F.slice(pieces, F.lit(1), F.size(pieces) - 1)).alias("_at", "line"))
    line_no = F.struct(F.col("place").alias("block"), F.col("_at").cast("bigint").alias("id"))
    return rows.select("file", line_no.alias("line_no"), "line")


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines of text files with (file, line_no). ``line_no`` orders the lines of one file.

    It is (offset of the file split, running id within the task), so a file of any size is read
    by many tasks and never whole. It is for ordering only and does not count lines.
    """
    packed = _packed(spark, path, glob)
    if packed is not None:
        return _packed_lines(packed)
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("line_no"),
        F.col("value").alias("line"),
    )


def parse_records(records: DataFrame, text: str = "record") -> DataFrame:
    """``Key: value`` lines of a status record as a map column ``fields``; client NULLs are NULL."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda s: s.contains(":"))
    keys = F.transform(lines, lambda s: F.trim(F.substring_index(s, ":", 1)))
    values = F.transform(
        lines, lambda s: client_null(F.trim(F.substring(s, F.instr(s, ":") + 1, F.length(s))))
    )
    # Of a repeated key the last value is kept, as for output that is read line by line: both
    # arrays are turned round, and the first place of each key is its last one in the text.
    rows = records.withColumn("_keys", F.reverse(keys)).withColumn("_values", F.reverse(values))
    names = F.array_distinct("_keys")
    found = F.transform(
        names, lambda k: F.element_at("_values", F.array_position("_keys", k).cast("int"))
    )
    fields = F.map_from_arrays(names, found)
    return rows.withColumn("fields", fields).drop(text, "_keys", "_values")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Vertical client output: one row (file, fields) per record.

    The record mark is the reader's line separator, so records of several lines are still read in
    parallel.
    """
    packed = _packed(spark, path)
    if packed is not None:
        raw = packed.select("file", F.explode(F.split("text", rf"\Q{RECORD_MARK}\E")).alias("record"))
    else:
        raw = spark.read.option("lineSep", RECORD_MARK).text(path)
        raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    return parse_records(raw.filter(F.col("record").contains(":")))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a delimited report (file, line); see ``replication_subscriptions``."""
    packed = _packed(spark, path)
    if packed is not None:
        return _packed_lines(packed).select("file", "line")
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")
    )


def read_listing(
    spark: SparkSession, path: str, glob: str = "*", modified_after: str | None = None
) -> DataFrame:
    """Files under ``path`` as (path, length, modified); their content is not read."""
    if path.rstrip("/").endswith(PACKED):
        since = {"modifiedAfter": modified_after} if modified_after else {}
        rows = spark.read.options(**since).schema(_PACKED_SCHEMA).parquet(path)
        rows = rows.filter(F.regexp_extract("file", "[^/]*$", 0).rlike(_glob_pattern(glob)))
        return rows.groupBy(F.col("file").alias("path")).agg(
            F.sum("length").alias("length"), F.max("_metadata.file_modification_time").alias("modified")
        )
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select(
        F.regexp_replace("path", "^file:", "").alias("path"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def read_sheet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A request sheet: CSV with a header row; all columns are text, carriage returns removed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(path)
    return rows.select(*[F.replace(F.col(c), F.lit("\r"), F.lit("")).alias(c) for c in columns])


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """A pattern file, one fixed string per line; blank lines drop out."""
    return spark.read.text(path).filter(F.col("value") != "").select(F.col("value").alias("pattern"))


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """The rows of a query over JDBC, in ``partitions`` ranges of a column where one is given.

    One-byte integers stay integers. Credentials come in ``properties`` from the caller.
    """
    reader = spark.read.format("jdbc").option("url", url).option("tinyInt1isBit", "false")
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is None or bounds is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


def read_catalog(
    spark: SparkSession, path: str, kind: str, pattern: str = r"dbserver_id=(\d+)"
) -> DataFrame:
    """Captured catalog output of one object type as (dbserver_id, dbschema, name, definition).

    Tab-separated lines: the schema, then the client's columns, of which the first is the name and the
    one of DEFINITION_COLUMN the definition. The server's number is cut from the path.
    """
    field = F.split("line", "\t")

    def column(n: int):
        return decode_field(F.get(field, F.lit(n)))

    server = F.regexp_extract("file", pattern, 1)
    return read_lines(spark, path).select(
        F.nullif(server, F.lit("")).cast("int").alias("dbserver_id"),
        column(0).alias("dbschema"),
        column(1).alias("name"),
        column(DEFINITION_COLUMN[kind]).alias("definition"),
    )


def catalog_columns(spark: SparkSession, table: str) -> DataFrame:
    """Columns of a catalog table as (column_name, data_type)."""
    rows = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "column_name string, data_type string")
