"""Removal of repeated strings by sparse prefix doubling.

Prefix doubling gives every position a rank by the string that begins there, and lengthens the
strings round by round from pairs of ranks; a position whose rank is unique is done, and so is one
whose string has reached the threshold. Here positions are first sampled (:mod:`positions`): each
stands for the run of windows, strings of threshold length, that have their least gram there. A round
groups the pairs (rank of what all windows of a run share, rank of what they cover together):

* what they cover occurs again: all windows of the run are repeated, past the threshold, done;
* what they share occurs nowhere else: none is repeated, unique, done;
* else the run goes on, cut into shorter runs, whose windows share more.

The runs shrink from one sampled position (about 190 windows) to ``STEP`` windows to one, the shared
prefix grows from a gram to threshold - STEP + 1 bytes to the threshold. Of runs that cover the same
string one goes on for all, as what others may be equal to. Ranks are 128-bit digests of the strings,
so that a group of equal strings needs no common task: it is counted before and after the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import slices, stored, text_bytes, text_of
from fleetwarden.llm.positions import GRAM, sampled
from fleetwarden.operators.lookup import look_up
from fleetwarden.session import discard, scratch_dir, shuffles_removed

LENGTH = 400  # bytes
STEP = 16  # windows of a run in the second round

TEXT = ["t1", "t2"]  # 128 bits that name a text; equal texts are one
_RUN = "t1 bigint, t2 bigint, place bigint, low int, high int, done boolean, s1 bigint, s2 bigint, c1 bigint, c2 bigint"


def _rank(view: memoryview) -> tuple[int, int]:
    from xxhash import xxh3_128_digest

    return tuple(np.frombuffer(xxh3_128_digest(view), np.int64).tolist())


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    """Columns of numbers as Arrow arrays, by a DDL schema."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    n = schema.count(",") + 1
    return _batch([list(c) for c in zip(*rows, strict=True)] if rows else [[]] * n, schema)


def _named(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def _first_runs(rows: DataFrame, length: int) -> DataFrame:
    """A run for each sampled position: windows that start at place - high to place - low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            flat, bounds = text_bytes(batch.column("text"))
            place, first, last, gram = sampled(flat, bounds, length)
            view = memoryview(flat)
            cover = [_rank(view[x : y + length]) for x, y in zip(first.tolist(), last.tolist(), strict=True)]
            c = np.array(cover, np.int64).reshape(-1, 2)
            of = np.searchsorted(bounds, first, "right") - 1
            t1, t2 = (batch.column(t).to_numpy()[of] for t in TEXT)
            shared = gram.view(np.int64)
            zeros = np.zeros(len(of), bool)
            yield _batch(
                [t1, t2, place - bounds[of], place - last, place - first, zeros, shared, 0 * shared, c[:, 0], c[:, 1]], _RUN
            )

    return rows.mapInArrow(run, _RUN)


def _shorter_runs(texts_: DataFrame, length: int, step: int) -> DataFrame:
    """The runs of each text cut into runs of ``step`` windows, on a grid from the sampled place.

    ``texts_`` has t1, t2, text and the array ``runs``. The shared string is that of the whole cell of
    the grid, so that it compares between texts. A cell at the end of a run is not covered by it: the
    rest is another run's, and would be counted twice. It gets a rank of its own and so goes on, unless
    what it shares is unique. The rest may be a run of the same place, where a block of a very long text
    ends: the rank names the windows too.
    """
    fields = ["place", "low", "high", "done"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            flat, bounds = text_bytes(batch.column("text"))
            view, out = memoryview(flat), []
            t1s, t2s = (batch.column(t).to_pylist() for t in TEXT)
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                begin = int(bounds[i])
                for place, low, high, done in (tuple(r[f] for f in fields) for r in runs):
                    for cell in range(low // step * step, high + 1, step):
                        far = cell + step - 1  # the first window of the cell starts at place - far
                        shared = _rank(view[begin + place - cell : begin + place - far + length])
                        least, most = max(low, cell), min(high, far)
                        if (least, most) == (cell, far):
                            cover = _rank(view[begin + place - far : begin + place - cell + length])
                        else:
                            cover = _rank(memoryview(f"{t1s[i]} {t2s[i]} {place} {least} {most}".encode()))
                        out.append((t1s[i], t2s[i], place, least, most, done, *shared, *cover))
                        if len(out) >= 1 << 16:
                            yield _columns(out, _RUN)
                            out = []
            yield _columns(out, _RUN)

    return texts_.select(*TEXT, "text", "runs").mapInArrow(run, _RUN)


def _repeated(runs: DataFrame, twice: DataFrame) -> DataFrame:
    """Windows of the runs that cover a string of ``twice``; of done ones they are known."""
    found = look_up(runs.filter("not done"), twice, ["c1", "c2"], "left_semi")
    found = found.select(*TEXT, (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last"))
    return found.distinct()


def _classes(runs: DataFrame) -> DataFrame:
    """Equal covered strings make a class; any one of its runs speaks for it. What is unique is left out."""
    # Runs of a class differ in text and place only, so that the other columns need no row of their own.
    classes = runs.groupBy("c1", "c2").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("done").alias("done"),
        F.min("t1").alias("t1"),
        F.min_by("t2", "t1").alias("t2"),
        F.min_by("place", "t1").alias("place"),
        *[F.max(c).alias(c) for c in ("low", "high", "s1", "s2")],
    )
    # Shared by several classes: straight from the runs, as a class is within one shared string.
    ends = runs.groupBy("s1", "s2").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("c1", "c2")])
    several = ends.filter("min_c1 < max_c1 or min_c2 < max_c2").select("s1", "s2", F.lit(True).alias("_open"))
    return look_up(classes, several, ["s1", "s2"]).filter("n > 1 or _open").drop("s1", "s2")


def _next_runs(rows: DataFrame, open_: DataFrame, length: int, step: int) -> DataFrame:
    """Shorter runs of the open ones, from their texts: each distinct text is fetched once."""
    # As many runs as one text has positions at most.
    of_text = open_.groupBy(*TEXT).agg(F.collect_list(F.struct("place", "low", "high", "done")).alias("runs"))
    bodies = rows.groupBy(*TEXT).agg(F.first("text").alias("text"))
    return _shorter_runs(bodies.join(of_text, TEXT), length, step)


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(t1, t2, first, last): where windows start in a text (t1, t2, text) that also start elsewhere."""
    if length < 2 * GRAM:
        raise ValueError(f"the threshold must be {2 * GRAM} bytes at least")
    # A round's tables go as soon as the next has what it needs of them; only what is repeated stays.
    spark = rows.sparkSession
    base = scratch_dir(spark, "windows")
    parts = []
    with shuffles_removed(spark):
        runs = stored(_first_runs(rows, length), "runs_0", base)
        for i, step in enumerate((STEP, 1)):
            classes = stored(_classes(runs), f"classes_{i}", base)
            twice = classes.filter("n > 1").select("c1", "c2")
            parts.append(stored(_repeated(runs, twice), f"repeated_{i}", base))
            discard(spark, f"{base}/runs_{i}")
            open_ = classes.filter("_open").withColumn("done", F.col("done") | (F.col("n") > 1))
            runs = stored(_next_runs(rows, open_, length, step), f"runs_{i + 1}", base)
            discard(spark, f"{base}/classes_{i}")
        # A run is one window now, which covers what it shares: none is open.
        twice = runs.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("c1", "c2")
        parts.append(stored(_repeated(runs, twice), "repeated_2", base))
        discard(spark, f"{base}/runs_2")
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def merged(firsts: list[int], lasts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes (begin, end) that the windows cover."""
    out: list[tuple[int, int]] = []
    for begin, last in sorted(zip(firsts, lasts, strict=True)):
        end = last + length
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, text, firsts, lasts: where repeated windows start.

    See :func:`remove_repeats` for the rules.
    """
    rows = _named(docs, text_col)
    found = repeated_windows(rows, length).groupBy(*TEXT).agg(F.collect_list(F.struct("first", "last")).alias("_w"))
    with_id = docs.select(
        F.col(id_col).alias("doc_id"),
        text_of(text_col).alias("text"),
        F.xxhash64(text_of(text_col)).alias("t1"),
        F.xxhash64(F.lit(1), text_of(text_col)).alias("t2"),
    )
    return look_up(with_id, found, TEXT).select(
        "doc_id", "text", F.col("_w.first").alias("firsts"), F.col("_w.last").alias("lasts")
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_bytes: bool = True
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and kept.

    Every byte is removed that lies in a string of ``length`` bytes which also starts anywhere else,
    in the same text or another; strings are judged on the input. n_spans counts the maximal removed
    runs, ``spans`` lists them (begin, end), ``kept`` holds the remaining bytes (which need not be
    UTF-8; left out without ``keep_bytes``) and kept_sha256 their digest. NULL and empty texts, and texts shorter than
    ``length``, lose nothing; a row repeated with its whole text loses all of it if it is that long.
    Ids may be NULL or repeated: rows are told apart by their texts. Other columns are not read.
    """
    rows = repeated_spans(docs, id_col, text_col, length)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>"
    schema += ", kept binary" if keep_bytes else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, bounds = text_bytes(batch.column("text"))
            view, out = memoryview(flat), []
            lists = zip(batch.column("firsts").to_pylist(), batch.column("lasts").to_pylist(), strict=True)
            for i, (firsts, lasts) in enumerate(lists):
                text = view[bounds[i] : bounds[i + 1]]
                spans = merged(firsts or [], lasts or [], length)
                edges = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept))
            sizes, removed, counts, digests, spans_, kept_ = (list(c) for c in zip(*out, strict=True))
            span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            listed = [[{"begin": a, "end": b} for a, b in s] for s in spans_]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(counts, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(listed, pa.list_(span)),
            }
            if keep_bytes:
                columns["kept"] = pa.array(kept_, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, schema)
