"""An index of fixed strings by one gram each, and the texts that may hold one of them.

A string can only occur in a text that holds each of its grams, so one gram that few strings have
finds all candidates by equality. Grams are taken from the bytes of whole batches at once. What a text
is cut into never leaves the task that cuts it, but for the keys whose bit is set in a bitmap of the
index; and the texts are never built into a hash table or broadcast: they stream past the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.session import stored

# Lengths of grams in bytes; a string is indexed by the longest that fits it, the empty one by none.
GRAMS = (16, 8, 4, 3, 2, 1, 0)
# Keys of an index are bits of 512 KiB, whatever the number of strings: a table that stays in a core's cache.
BITMAP_BITS = 22
# Places of a text that are looked at together, for the same reason.
BLOCK = 1 << 15
_ODD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15))


def _keys(flat: np.ndarray, start: int, n: int, length: int) -> np.ndarray:
    """The 64-bit keys of the grams of ``length`` bytes that begin at ``n`` places from ``start`` on.

    Multiplication by an odd number is one to one, and its high bits depend on all bytes.
    """

    def window(at: int, width: int) -> np.ndarray:
        found = np.ndarray((n,), "<u8", flat.data, at, (1,))
        return found & np.uint64((1 << 8 * width) - 1) if width < 8 else found

    key = (window(start, min(length, 8)) ^ np.uint64(length)) * _ODD[0]
    if length > 8:
        key = ((key ^ (key >> np.uint64(32))) + window(start + 8, length - 8)) * _ODD[1]
    return key


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts end to end, 16 more, and where each begins; NULLs must be gone."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.zeros(int(bounds[-1] - bounds[0]) + 16, np.uint8)
    if data is not None:
        flat[:-16] = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return flat, bounds - bounds[0]


def _pieces(texts: pa.Array, length: int, bitmap: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, key) of its distinct grams, only those with a bit in ``bitmap`` if given."""
    flat, bounds = _flat(texts)
    if length == 0:
        return np.arange(len(texts)), np.zeros(len(texts), np.uint64)
    owners, keys = [], []
    for start in range(0, int(bounds[-1]), BLOCK):
        key = _keys(flat, start, min(BLOCK, int(bounds[-1]) - start), length)
        at = np.arange(len(key)) if bitmap is None else np.flatnonzero(_is_set(bitmap, key))
        owner = np.searchsorted(bounds, at + start, "right") - 1
        whole = at + start + length <= bounds[owner + 1]  # no gram crosses the end of its text
        owners.append(owner[whole])
        keys.append(key[at[whole]])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    return owner[new], key[new]


def _is_set(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key >> np.uint64(64 - BITMAP_BITS)
    word = bitmap[(place >> np.uint64(6)).astype(np.int64)]
    return (word >> (place & np.uint64(63))) & np.uint64(1) != 0


def gram_index(strings: DataFrame, column: str) -> DataFrame:
    """(``column``, _length, _gram): each distinct string, and the key of its gram that fewest strings have.

    NULLs are left out. The result is stored, so that its size is known to whatever joins it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            sizes = pc.binary_length(texts.cast(pa.large_binary())).to_numpy(zero_copy_only=False)
            longest = np.array(GRAMS)[np.searchsorted(-np.array(GRAMS), -sizes)] if len(sizes) else sizes
            for length in GRAMS:
                chosen = texts.filter(pa.array(longest == length))
                owner, key = _pieces(chosen, length, None)
                yield pa.RecordBatch.from_arrays(
                    [chosen.take(pa.array(owner)), pa.array(np.full(len(key), length, np.int32)), pa.array(key.view(np.int64))],
                    [column, "_length", "_gram"],
                )

    wanted = strings.select(column).filter(F.col(column).isNotNull()).distinct()
    grams = wanted.mapInArrow(run, f"`{column}` string, _length int, _gram bigint")
    shared = grams.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_gram")))
    best = F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram")
    return stored(shared.groupBy(column, "_length").agg(best), "gram-index")


def _bitmap(index: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bits of all keys of the index, and its lengths; what reaches the driver is bounded by the bitmap."""
    place = F.shiftrightunsigned("_gram", 64 - BITMAP_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftrightunsigned(place, 6).cast("int").alias("word")
    found = index.groupBy("_length", word).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    np.bitwise_or.at(out, found.column("word").to_numpy(), found.column("bits").to_numpy().view(np.uint64))
    return out, sorted(found.column("_length").unique().to_pylist())


def gram_hits(texts: DataFrame, column: str, index: DataFrame) -> DataFrame:
    """(``column``, _gram): texts, with the keys of those of their grams that the index may have.

    NULLs are left out; a text that meets no bit of the index gives no row. Equal texts of one batch are
    looked at once, those of different batches come again.
    """
    bitmap, lengths = _bitmap(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).unique()
            own = own.filter(own.is_valid())
            for length in lengths:
                owner, key = _pieces(own, length, bitmap)
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(owner)), pa.array(key.view(np.int64))], [column, "_gram"]
                )

    return texts.select(column).mapInArrow(run, f"`{column}` string, _gram bigint")


def holding(texts: DataFrame, column: str, index: DataFrame, match: Column) -> DataFrame:
    """The distinct texts that meet an entry of ``index`` in a gram and satisfy ``match`` with it.

    ``match`` may use all columns of both. The join is a semi join: it can build the index only.
    """
    met = gram_hits(texts, column, index).withColumnRenamed("_gram", "_piece")
    return met.join(index, (F.col("_piece") == F.col("_gram")) & match, "left_semi").select(column).distinct()
