"""What several operators share: text input, stored intermediate tables, Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.session import stored

__all__ = ["packed", "shuffle_partitions", "slices", "stored", "text_bytes", "text_of", "texts"]


def text_of(column: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) and nothing else, so that no further column of the input can clash."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def packed(rows: DataFrame, name: str = "_row") -> DataFrame:
    """The whole row as one struct, so that helper columns cannot clash with its columns."""
    return rows.select(F.struct(*[rows[c] for c in rows.columns]).alias(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow string column end to end, and where each begins.

    The second array has one entry more than there are texts. Nothing is copied. NULL is empty.
    """
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    first, n = column.offset, len(column)
    bounds = np.frombuffer(offsets, kind)[first : first + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Each batch cut into slices of whole rows with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        if not batch.num_rows:
            continue
        _, bounds = text_bytes(batch.column(at))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
            end = max(end, start + 1)
            yield batch.slice(start, end - start)
            start = end
