"""Near-duplicate documents by b-bit MinHash.

Candidates come from bands of full minima; of every minimum only the low bits are kept and packed
into a signature, and the similarity estimated from equal bit groups, corrected for groups that are
equal by chance, decides which candidates are compared on their full sets.

No bucket is expanded into all its pairs. Texts with the same set are one class. In each bucket all
classes are first compared with one pivot. What these links do not join (mostly nothing) is compared
in blocks of bounded size, and only between different components, so that no candidate is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import packed, slices, stored, texts
from fleetwarden.llm.components import components
from fleetwarden.llm.shingles import mix, shingle_sets
from fleetwarden.operators.lookup import look_up

HASHES = 256
BITS = 4
# Bands of four minima, from the first half of the hash functions: a pair at the threshold shares
# none once in 190,000 times.
BANDS, ROWS = 32, 4
THRESHOLD = 75  # percent
# How often an estimate rules out a pair at the threshold, at most.
LOSS = 1 / 3_000_000
# Bytes of text in one side of a block of the last stage.
BLOCK_BYTES = 4 << 20

_LANES = HASHES * BITS // 64
_ONES = int("1" * (64 // BITS), 16)  # the lowest bit of each group of four
_MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None] * _MULTIPLIERS
        np.minimum(least, part.min(0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * ROWS].reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in rows.T:
        keys = mix(keys ^ column)
    return keys.view(np.int64)


def signature(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into 64-bit lanes."""
    # Low bits of a product follow from the low bits of its factors; mixed, they differ by hash function.
    low = mix(least) & np.uint64((1 << BITS) - 1)
    places = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(_LANES, -1) << places).sum(1, dtype=np.uint64).view(np.int64)


def least_matches(threshold: int = THRESHOLD, loss: float = LOSS) -> int:
    """Equal minima that a pair at the threshold has at least, but for a share of ``loss``.

    The binomial tail itself, without groups that are equal by chance: those only add matches.
    """
    j, below = threshold / 100, 0.0
    for k in range(HASHES):
        below += comb(HASHES, k) * j**k * (1 - j) ** (HASHES - k)
        if below > loss:
            return k
    return HASHES


def matches(a: str, b: str) -> Column:
    """Equal bit groups of two packed signatures: XOR, fold each group onto one bit, count."""
    total = F.lit(0)
    for lane in range(_LANES):
        differ = F.col(a)[lane].bitwiseXOR(F.col(b)[lane])
        half = differ.bitwiseOR(F.shiftrightunsigned(differ, 1))
        whole = half.bitwiseOR(F.shiftrightunsigned(half, 2)).bitwiseAND(F.lit(_ONES))
        total = total + F.bit_count(whole)
    return F.lit(HASHES) - total


def similarity(matched: Column) -> Column:
    """Estimated Jaccard similarity, corrected for groups that are equal by chance."""
    chance = 2.0**-BITS
    return F.greatest((matched / F.lit(HASHES) - chance) / (1 - chance), F.lit(0.0))


FEATURES = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, signature array<bigint>"


def features(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set), bands, signature of (doc_id, text)."""
    from xxhash import xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys, bands, packs = [], [], [], []
            for found in shingle_sets(batch.column("text")):
                sizes.append(len(found))
                if len(found):
                    least = minima(found)
                    keys.append(xxh3_128_digest(found.tobytes()))
                    bands.append(band_keys(least))
                    packs.append(signature(least))
                else:
                    keys.append(None)
                    bands.append(None)
                    packs.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(packs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "bands", "signature"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, FEATURES)


def linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """100 * intersection >= threshold * union, of two sorted sets."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _confirm(pairs: DataFrame, threshold: int) -> DataFrame:
    """Of (a, b, text_a, text_b), the (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            left = shingle_sets(batch.column("text_a"))
            right = (s for part in slices([batch], "text_b") for s in shingle_sets(part.column("text_b")))
            keep = [linked(x, y, threshold) for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _with_texts(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """text_a and text_b for pairs (a, b); either may be a very frequent id."""
    first = bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return look_up(look_up(pairs, first, ["a"]), second, ["b"])


def _block_links(rest: DataFrame, threshold: int) -> DataFrame:
    """Links inside blocks of (bucket, i, j): rows with side 0 against rows with side 1."""
    floor = least_matches(threshold)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["side", "doc_id"])
        xs, ys = (block[block["side"] == s].reset_index(drop=True) for s in (0, 1))
        out: list[tuple[int, int]] = []
        if len(xs) and len(ys):
            sets: dict[int, np.ndarray] = {}

            def shingles(rows: pd.DataFrame, i: int) -> np.ndarray:
                key = int(rows["doc_id"][i])
                if key not in sets:
                    sets[key] = next(shingle_sets(pa.array([rows["text"][i]], pa.large_string())))
                return sets[key]

            packs = np.stack(ys["signature"].to_numpy()).view(np.uint64)
            of, ids = ys["component"].to_numpy(), ys["doc_id"].to_numpy()
            for i in range(len(xs)):
                differ = packs ^ np.asarray(xs["signature"][i]).view(np.uint64)
                for shift in (1, 2):
                    differ = differ | (differ >> np.uint64(shift))
                equal = HASHES - np.bitwise_count(differ & np.uint64(_ONES)).sum(1, dtype=np.int64)
                own, joined = int(xs["component"][i]), set()
                near = np.flatnonzero((equal >= floor) & (of != own))
                for j in near[np.argsort(-equal[near], kind="stable")].tolist():
                    # One link to a component is enough: the others change nothing.
                    if of[j] not in joined and linked(shingles(xs, i), shingles(ys, j), threshold):
                        joined.add(of[j])
                        out.append((int(xs["doc_id"][i]), int(ids[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rest.groupBy("bucket", "i", "j").applyInPandas(run, "a bigint, b bigint")


def _rest(members: DataFrame, labels: DataFrame, classes: DataFrame, bodies: DataFrame, threshold: int) -> DataFrame:
    """Links that the comparison with the pivots cannot have shown.

    ``members`` (bucket, doc_id, pivot). A bucket matters if its members beside the pivot lie in
    different components. There, those outside the pivot's component (side 0) are compared with all
    others (side 1), in blocks.
    """
    label = labels.select(F.col("id").alias("doc_id"), "component")
    rows = look_up(members.filter("doc_id <> pivot"), label, ["doc_id"])
    rows = rows.withColumn("component", F.coalesce("component", "doc_id"))
    top = labels.select(F.col("id").alias("pivot"), F.col("component").alias("_top"))
    rows = look_up(rows, top, ["pivot"]).withColumn("_top", F.coalesce("_top", "pivot"))
    sizes = classes.select("doc_id", "n_shingles", "signature")
    rows = look_up(rows, sizes, ["doc_id"]).withColumn("_out", F.col("component") != F.col("_top"))
    open_ = (
        rows.groupBy("bucket")
        .agg(
            F.min("component").alias("_low"),
            F.max("component").alias("_high"),
            # Eight bytes for each shingle, and as much again for the text.
            F.sum(F.when(F.col("_out"), F.col("n_shingles") * 16 + 128)).alias("_x"),
            F.sum(F.col("n_shingles") * 16 + 128).alias("_y"),
        )
        .filter("_low <> _high")
        .select("bucket", *[F.ceil(F.col(c) / BLOCK_BYTES).cast("int").alias(c) for c in ("_x", "_y")])
    )
    rows = look_up(rows, open_.withColumn("_open", F.lit(True)), ["bucket"]).filter("_open")
    rows = look_up(rows, bodies, ["doc_id"])
    spread = F.xxhash64("doc_id")

    def side(number: int, own: str, other: str, part: str, across: str) -> DataFrame:
        chosen = rows.filter("_out") if number == 0 else rows
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(across)
        return chosen.select(
            "bucket", "doc_id", "component", "signature", "text",
            F.pmod(spread, F.col(own)).cast("int").alias(part), F.lit(number).alias("side"), every,
        ).select("bucket", "i", "j", "side", "doc_id", "component", "signature", "text")

    return _block_links(side(0, "_x", "_y", "i", "j").unionByName(side(1, "_y", "_x", "j", "i")), threshold)


def near_classes(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id of (doc_id, text)."""
    found = stored(features(docs), "features")
    filled = found.filter("n_shingles > 0")
    firsts = filled.groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    class_of = stored(
        look_up(found.select("doc_id", "n_shingles", "set_key"), firsts, ["set_key"]).drop("set_key"), "classes"
    )
    reps = class_of.filter("doc_id = first_id").select("doc_id").distinct()
    classes = look_up(filled.dropDuplicates(["doc_id"]), reps, ["doc_id"], "left_semi")
    classes = stored(classes.select("doc_id", "n_shingles", "bands", "signature"), "signatures")

    banded = classes.select("doc_id", F.explode("bands").alias("bucket"))
    pivots = banded.groupBy("bucket").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("_last"))
    pivots = pivots.filter("pivot < _last").drop("_last")
    members = stored(look_up(banded, pivots, ["bucket"]).filter("pivot is not null"), "members")

    star = members.filter("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    pack = classes.select("doc_id", "signature")
    star = look_up(star, pack.select(F.col("doc_id").alias("a"), F.col("signature").alias("_sa")), ["a"])
    star = look_up(star, pack.select(F.col("doc_id").alias("b"), F.col("signature").alias("_sb")), ["b"])
    star = stored(star.filter(matches("_sa", "_sb") >= least_matches(threshold)).select("a", "b"), "star")

    # The texts of candidates, once: all later stages read only these.
    wanted = members.select("doc_id").distinct()
    bodies = docs.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("text").alias("text"))
    bodies = stored(bodies, "candidate-texts")
    links = stored(_confirm(_with_texts(star, bodies), threshold), "links")
    more = stored(_rest(members, components(links), classes, bodies, threshold), "more-links")
    labels = components(links.unionByName(more)).select(F.col("id").alias("first_id"), F.col("component").alias("_c"))
    return look_up(class_of, labels, ["first_id"]).select(
        "doc_id", "n_shingles", F.coalesce("_c", "first_id", "doc_id").alias("component_id")
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= ``threshold`` * union of their shingle sets
    (:mod:`shingles`); component_id is the least id reachable over links, the document itself
    included, and kept says that it is the document's own. NULL, empty and blank texts have no
    shingles and are linked with nothing. Ids are integers that name a text each: repeated rows all
    come out alike. Rows with a NULL id get a NULL component_id, are linked with nothing and are kept.
    """
    rows = texts(docs, id_col, text_col)
    named = near_classes(rows.filter("doc_id is not null"), threshold)
    unnamed = features(rows.filter("doc_id is null")).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(unnamed).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """The rows that :func:`near_dedup` keeps, with all their columns: of each group the least id."""
    kept = near_dedup(docs, id_col, text_col, threshold).filter("kept").select(F.col("doc_id").alias("_kept_id"))
    rows = packed(docs).withColumn("_id", F.col(f"_row.{id_col}"))
    return rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")), "left_semi").select("_row.*")
