"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the ``SIZE`` least hashes of a text's shingles (:mod:`shingles`), 48 bits each, as
base64. The fingerprint of a union is made from the fingerprints of its parts, and two fingerprints
give the resemblance, the containment and the number of distinct shingles; a set of fewer shingles
than ``SIZE`` is held whole, and the figures are exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.llm.common import shuffle_partitions, slices, text_of
from fleetwarden.llm.shingles import shingle_sets

SIZE = 128
_BITS, _WIDTH = 48, 6  # bits and bytes of a stored hash
_LAST = (1 << 63) - 1


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least hashes of a sorted set, shortened."""
    return np.unique(shingles[:SIZE] >> np.uint64(64 - _BITS))


def to_text(hashes: np.ndarray) -> str:
    wide = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _WIDTH :]
    return base64.b64encode(wide.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, _WIDTH)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - _WIDTH :] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def _known(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sketches up to the value below which both are complete."""
    limit = min((int(x[-1]) for x in (a, b) if len(x) >= SIZE), default=1 << 62)
    limit_ = np.uint64(limit)
    return a[: np.searchsorted(a, limit_, "right")], b[: np.searchsorted(b, limit_, "right")]


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; two empty sets are alike, an empty one is unlike any other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b = _known(a, b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first set that is in the second; an empty set is in every set."""
    if not len(a):
        return 1.0
    a, b = _known(a, b)
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def distinct(a: np.ndarray) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < SIZE else (SIZE - 1) * 2.0**_BITS / float(a[-1] + np.uint64(1))


def _pairwise(name: str, figure):
    @F.arrow_udf(T.DoubleType())
    def compare(first: pa.Array, second: pa.Array) -> pa.Array:
        pairs = zip(first.to_pylist(), second.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else figure(from_text(x), from_text(y)) for x, y in pairs], pa.float64())

    def column(first: str, second: str) -> Column:
        return compare(F.col(first), F.col(second)).alias(name)

    return column


resemblance_of = _pairwise("resemblance", resemblance)
containment_of = _pairwise("containment", containment)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint, n_shingles (estimated). NULL texts count as empty."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sketch(s) for s in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([to_text(s) for s in found], pa.string()),
                    pa.array([distinct(s) for s in found], pa.float64()),
                ],
                ["doc_id", "fingerprint", "n_shingles"],
            )

    return rows.mapInArrow(run, "doc_id bigint, fingerprint string, n_shingles double")


def merge_fingerprints(parts: DataFrame, keys: Sequence[str], fingerprint_col: str = "fingerprint") -> DataFrame:
    """(keys, fingerprint) of the union of the parts of each key.

    Each map task sends on the least ``SIZE`` hashes of a key at most, so that a key with very many
    parts costs no task more. NULL fingerprints count as empty sets.
    """
    raw = F.unbase64(F.coalesce(F.col(fingerprint_col), F.lit("")))
    count = (F.length("_raw") / _WIDTH).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(F.col("_raw"), (i - 1) * _WIDTH + 1, F.lit(_WIDTH)))
    rows = parts.select(*keys, raw.alias("_raw")).withColumn(
        "_h", F.explode_outer(F.when(count > 0, pieces))
    )
    least = rows.select(*keys, "_h").distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_h").asc_nulls_last()))
    least = least.withColumn("_rank", rank).filter(F.col("_rank") <= SIZE)
    ordered = F.array_sort(F.collect_list(F.struct("_rank", "_h")))
    joined = F.aggregate(ordered, F.lit("").cast("binary"), lambda s, x: F.concat(s, F.coalesce(x["_h"], F.lit("").cast("binary"))))
    return least.groupBy(*keys).agg(F.base64(joined).alias("fingerprint")).select(
        *keys, F.regexp_replace("fingerprint", r"\s", "").alias("fingerprint")
    )


def _range_of(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are less than ``order``, by binary search."""
    depth = max(1, len(bounds).bit_length())
    padded = F.lit(bounds + [_LAST] * ((1 << depth) - 1 - len(bounds)))
    steps = F.lit([1 << i for i in reversed(range(depth))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.element_at(padded, at + step) < order, step).otherwise(0)
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited text and that of the next document.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document, in descending order of the integer id, after the last one the first.
    One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (resemblances). NULL texts count as empty; rows that share an id follow each
    other by text; NULL ids come last. No rows give no rows; a single row is its own next.

    The rows are dealt once into ranges of ids; the first row of each range goes also to the range
    whose last row it follows. Only the ranges' bounds and first ids (one each) reach the driver.
    """
    n = shuffle_partitions(docs.sparkSession)
    order = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-_LAST - 1))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), order.alias("_order"), text_of(text_col).alias("text"))
    shares = [i / n for i in range(1, n)]
    bounds: list[int] = []
    if shares:
        found = rows.agg(F.percentile_approx("_order", shares, max(10_000, 20 * n)).alias("b")).first()["b"]
        bounds = sorted(set(found or []))
    rows = rows.withColumn("_range", _range_of(F.col("_order"), bounds))
    heads = {r["_range"]: r["m"] for r in rows.groupBy("_range").agg(F.max("_order").alias("m")).collect()}
    filled = sorted(heads) or [0]
    # The range before a range in descending order is the next higher one that has rows.
    before = {r: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}
    parts = len(bounds) + 1
    head = F.element_at(F.lit([heads.get(r, _LAST) for r in range(parts)]), F.col("_range") + 1)
    target = F.element_at(F.lit([before.get(r, 0) for r in range(parts)]), F.col("_range") + 1)
    own = F.struct(F.col("_range").alias("part"), F.lit(False).alias("copy"))
    also = F.struct(target.alias("part"), F.lit(True).alias("copy"))
    places = F.when(F.col("_order") == head, F.array(own, also)).otherwise(F.array(own))
    dealt = (
        rows.withColumn("_place", F.explode(places))
        .select("doc_id", "_order", "text", "_place.part", "_place.copy")
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("copy", F.desc("_order"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_: tuple | None = None  # the last row so far: (id, is copy, text, sketch)
        for batch in slices(batches, "text"):
            found = [sketch(s) for s in shingle_sets(batch.column("text"))]
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "copy", "text")]
            line = ([before_] if before_ else []) + list(zip(*columns, found, strict=True))
            before_ = line[-1]
            pairs = [(x, y) for x, y in zip(line, line[1:], strict=False) if not x[1]]
            edited = []
            for (_, _, text, _), (_, _, other, _) in pairs:
                half = len(text) // 2
                edited.append(text[: len(text) - half] + other[:half])
            sketches = [
                sketch(s)
                for part in slices([pa.RecordBatch.from_arrays([pa.array(edited, pa.large_string())], ["text"])], "text")
                for s in shingle_sets(part.column("text"))
            ]
            out = [
                (
                    x[0], len(x[2]), hashlib.sha256(text.encode()).hexdigest(), to_text(x[3]), to_text(s),
                    resemblance(x[3], s), resemblance(x[3], y[3]),
                )
                for (x, y), text, s in zip(pairs, edited, sketches, strict=True)
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
