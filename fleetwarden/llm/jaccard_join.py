"""Exact Jaccard join of documents on word shingles, by partition of the universe and pigeonhole.

Sizes are dealt into bands. For a band the universe of shingle hashes is cut into equal ranges, the
segments. Two sets of which the Jaccard similarity reaches the threshold differ in at most
``H = (s + t) (100 - T) / (100 + T)`` shingles, s and t being their sizes; so of any H + 1 segments in
which a set has shingles, one holds the same subset in both. Such subsets, as 64-bit signatures, are
the index. A set is indexed in its own band, and if it can have smaller partners there, also in the
band below. Empty segments are never indexed.

What a set indexes is allocated by cost. Where it has shingles in more segments than it needs, those
with the fewest shingles, which most sets share, are left out first; of the rest, a number fixed by the
band is left out where the signature proved most frequent. Both orders depend on signatures alone, so two
sets agree on them and the cheapest subset that they share is kept by both. Where a set has shingles
in too few segments, it adds its one-deletion neighbourhoods: for each segment the subset and the
subset without each one shingle. Two such sets share one of these, or, where even that gives too
few, they are found by single shingles.

No bucket of a signature is expanded into pairs. Its sets are compared with one of them; what these
links do not join is compared in blocks, between components only. An exact bound comes first: the
parities of the shingles that fall on each bit of a sketch cannot differ in more places than the sets
do. What passes is verified on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.common import shuffle_partitions, slices, stored, texts
from fleetwarden.llm.components import components
from fleetwarden.llm.shingles import mix, shingle_sets
from fleetwarden.operators.lookup import look_up

THRESHOLD = 80  # percent
RATIO = 2.0  # of the ends of a band of sizes
# Signatures that a task gathers before it deals them out.
GATHERED = 1 << 20
# From this many equal signatures of one task on, they are settled there; also the highest cost.
FREQUENT = 16
# Text for which one task compares all signatures.
PART_BYTES = 32 << 20
PARTS_A_TASK = 4
# Bits of the largest sketch, and bytes of sketches or texts in one side of a block.
SKETCH_BITS = 1 << 16
BLOCK_BYTES = 4 << 20

_HOME, _SETTLED, _SPARE = 64, 128, 63  # of the byte that goes with a signature
_KEYS = mix(np.arange(1, 5, dtype=np.uint64))
_32 = np.uint64(32)


def differing(total: int, threshold: int) -> int:
    """How many shingles at most are in one of two sets only, if they link and have ``total`` in all."""
    return total * (100 - threshold) // (100 + threshold)


class Bands:
    """Ends of the bands of sizes, and what holds for each band."""

    def __init__(self, threshold: int) -> None:
        self.threshold, self.ends = threshold, [1]
        self.ratio = max(RATIO, 100 / threshold)

    def of(self, size: int) -> int:
        while self.ends[-1] <= size:
            self.ends.append(max(self.ends[-1] + 1, int(np.ceil(self.ends[-1] * self.ratio))))
        return int(np.searchsorted(self.ends, size, "right"))

    def roles(self, size: int) -> list[tuple[int, int, bool]]:
        """(band, most differing shingles, own band) of a set: its partners are no larger in the band below."""
        band, t = self.of(size), self.threshold
        out = [(band, differing(size + size * 100 // t, t), True)]
        if band > 1 and 100 * (self.ends[band - 1] - 1) >= t * size:
            out.append((band - 1, differing(size + self.ends[band - 1] - 1, t), False))
        return out

    def segments(self, band: int) -> int:
        return int(1.08 * self._most(band)) + 3

    def spare(self, band: int) -> int:
        return min(self._most(band) // 24 + 1, _SPARE)

    def _most(self, band: int) -> int:
        top = self.ends[band] - 1
        return differing(top + top * 100 // self.threshold, self.threshold)


def signatures(found: np.ndarray, mixed: np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, int]]:
    """Signatures of a sorted set and the byte that goes with them, for each of its bands."""
    for band, most, home in bands.roles(len(found)):
        segment = ((found >> _32) * np.uint64(bands.segments(band))) >> _32
        starts = np.concatenate(([0], np.flatnonzero(segment[1:] != segment[:-1]) + 1))
        sums = np.add.reduceat(mixed, starts)
        sizes = np.diff(np.append(starts, len(found)))
        place = mix(segment + np.uint64(band << 32))
        signs = mix(sums + mix(place[starts] ^ _KEYS[0]))
        role = _HOME if home else 0
        k = len(starts)
        if k > most:
            spare = min(bands.spare(band), k - most - 1)
            if k > most + 1 + spare:
                order = np.lexsort((signs, -sizes))[: most + 1 + spare]
                signs = signs[order]
            yield signs, role | spare
            continue
        yield signs, role
        around = mix(place ^ _KEYS[1])
        yield mix(sums + around[starts]), role
        wide = np.repeat(sizes > 1, sizes)
        yield mix((np.repeat(sums, sizes) - mixed + around)[wide]), role
        if k + int((sizes > 1).sum()) <= most:
            yield mix(found ^ mix(_KEYS[2:3] + np.uint64(band))), role


def sketch(mixed: np.ndarray) -> bytes:
    """Parities of the shingles on each of 2^k bits, twice as many as shingles at least."""
    bits = 64
    while bits < 2 * len(mixed) and bits < SKETCH_BITS:
        bits *= 2
    odd = np.bincount((mixed & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(lanes: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of 64-bit lanes) over fewer bits."""
    while lanes.shape[-1] > size:
        half = lanes.shape[-1] // 2
        lanes = lanes[..., :half] ^ lanes[..., half:]
    return lanes


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """100 * intersection >= threshold * union, of two sorted sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= threshold * (len(a) + len(b) - common)


_DEALT = "part int, doc_id bigint, n_shingles bigint, set_key binary, sketch binary, signs binary, ids binary, roles binary, firsts binary, counts binary"


def _dealt(docs: DataFrame, threshold: int, parts: int) -> DataFrame:
    """Rows of documents (signs NULL) and packed signatures, each dealt to a part by its value.

    Signatures that many sets of one task have do not travel: one of them stands for all, with
    their number, and the others are passed on as settled, to be joined with it.
    """
    from xxhash import xxh3_128_digest

    def packs(signs: np.ndarray, ids: np.ndarray, roles: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((ids, signs))
        signs, ids, roles = signs[order], ids[order], roles[order]
        first = np.concatenate(([0], np.flatnonzero(signs[1:] != signs[:-1]) + 1))
        sizes = np.diff(np.append(first, len(signs)))
        counts, firsts = np.repeat(np.minimum(sizes, FREQUENT), sizes), ids.copy()
        leads = np.zeros(len(signs), bool)
        leads[first] = True
        often = counts >= FREQUENT
        firsts[often] = np.repeat(ids[first], sizes)[often]
        home = np.repeat(np.add.reduceat((roles & _HOME > 0).astype(np.int64), first) > 0, sizes)
        settled = often & ~leads
        roles = np.where(often & leads & home, roles | _SETTLED, roles)  # stands for one of its own band
        counts = np.where(often, FREQUENT, 1).astype(np.uint8)
        part = (signs % np.uint64(parts)).astype(np.int64)
        # Settled ones go anywhere: they meet nobody there.
        part[settled] = -1 - (ids[settled] % parts)
        order = np.argsort(part, kind="stable")
        edges = np.append(np.concatenate(([0], np.flatnonzero(np.diff(part[order])) + 1)), len(order))
        columns: dict[str, list] = {c: [] for c in names}
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            at = order[low:high]
            columns["part"].append(int(part[at[0]]))
            for name, values in (("signs", signs), ("ids", ids), ("roles", roles), ("firsts", firsts), ("counts", counts)):
                columns[name].append(values[at].tobytes() if name != "firsts" or part[at[0]] < 0 else None)
            for name in ("doc_id", "n_shingles", "set_key", "sketch"):
                columns[name].append(None)
        yield batch_of(columns)

    kinds = [("part", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64())]
    kinds += [(c, pa.binary()) for c in ("set_key", "sketch", "signs", "ids", "roles", "firsts", "counts")]
    names = [c for c, _ in kinds]

    def batch_of(columns: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in kinds], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, held, total = Bands(threshold), [], 0
        for batch in slices(batches, "text"):
            columns: dict[str, list] = {c: [] for c in names}
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text")), strict=True):
                mixed = mix(found)
                columns["part"].append(doc_id % parts)
                columns["doc_id"].append(doc_id)
                columns["n_shingles"].append(len(found))
                columns["set_key"].append(xxh3_128_digest(found.tobytes()) if len(found) else None)
                columns["sketch"].append(sketch(mixed) if len(found) else None)
                for signs, role in signatures(found, mixed, bands) if len(found) else ():
                    held.append((signs, doc_id, role))
                    total += len(signs)
                if total >= GATHERED:
                    yield from flush(held)
                    held, total = [], 0
            yield batch_of(columns | {c: [None] * len(columns["part"]) for c in names[5:]})
        if total:
            yield from flush(held)

    def flush(held: list[tuple[np.ndarray, int, int]]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for s, _, _ in held])
        ids = np.repeat(np.array([i for _, i, _ in held], np.int64), sizes)
        roles = np.repeat(np.array([r for _, _, r in held], np.uint8), sizes)
        yield from packs(np.concatenate([s for s, _, _ in held]), ids, roles)

    return docs.select("doc_id", "text").mapInArrow(run, _DEALT)


_FOUND = (
    "doc_id bigint, n_shingles bigint, set_key binary, sketch binary, sign bigint, pivot bigint, "
    "home boolean, spare int, cost int"
)


def _met(dealt: DataFrame) -> DataFrame:
    """Rows of documents (sign NULL), and the members of buckets that several sets share.

    A member has the least id of its bucket that is known as ``pivot``, and the number of sets in it,
    at most FREQUENT, as ``cost``. A task holds the signatures of its parts.
    """

    def members(signs, ids, pivots, roles, costs) -> pa.RecordBatch:
        n = len(signs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                pa.array(signs.view(np.int64)), pa.array(pivots), pa.array(roles & _HOME > 0),
                pa.array((roles & _SPARE).astype(np.int32)), pa.array(np.asarray(costs, np.int32)),
            ],
            ["doc_id", "n_shingles", "set_key", "sketch", "sign", "pivot", "home", "spare", "cost"],
        )

    def of(blobs: list[bytes], kind) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {c: [] for c in ("signs", "ids", "roles", "counts")}
        for batch in batches:
            documents = batch.filter(batch.column("signs").is_null())
            if documents.num_rows:
                n = documents.num_rows
                empty = [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [documents.column(c) for c in ("doc_id", "n_shingles", "set_key", "sketch")] + empty,
                    ["doc_id", "n_shingles", "set_key", "sketch", "sign", "pivot", "home", "spare", "cost"],
                )
            packed = batch.filter(batch.column("signs").is_valid())
            for part, *blobs in zip(*(packed.column(c).to_pylist() for c in ("part", "signs", "ids", "roles", "firsts", "counts")), strict=True):
                signs, ids, roles, firsts, counts = blobs
                if part < 0:
                    own = np.frombuffer(signs, np.uint64)
                    yield members(own, np.frombuffer(ids, np.int64), np.frombuffer(firsts, np.int64),
                                  np.frombuffer(roles, np.uint8), np.full(len(own), FREQUENT))
                else:
                    for name, blob in (("signs", signs), ("ids", ids), ("roles", roles), ("counts", counts)):
                        held[name].append(blob)
        signs, ids, roles = of(held["signs"], np.uint64), of(held["ids"], np.int64), of(held["roles"], np.uint8)
        counts = of(held.pop("counts"), np.uint8)
        held.clear()
        if not len(signs):
            return
        order = np.lexsort((ids, signs))
        signs, ids, roles, counts = signs[order], ids[order], roles[order], counts[order]
        first = np.concatenate(([0], np.flatnonzero(signs[1:] != signs[:-1]) + 1))
        sizes = np.diff(np.append(first, len(signs)))
        costs = np.add.reduceat(counts.astype(np.int64), first)
        homes = np.add.reduceat((roles & (_HOME | _SETTLED) > 0).astype(np.int64), first)
        shared = np.repeat((costs > 1) & (homes > 0), sizes)
        pivots, costs = np.repeat(ids[first], sizes), np.repeat(np.minimum(costs, FREQUENT), sizes)
        at = np.flatnonzero(shared)
        for low in range(0, len(at), 1 << 16):
            i = at[low : low + (1 << 16)]
            yield members(signs[i], ids[i], pivots[i], roles[i], costs[i])

    return dealt.mapInArrow(run, _FOUND)


def _allocated(members: DataFrame) -> DataFrame:
    """Members without the ``spare`` most frequent signatures of each set and band."""
    order = Window.partitionBy("doc_id", "home").orderBy(F.desc("cost"), "sign")
    return members.withColumn("_rank", F.row_number().over(order)).filter("_rank > spare").drop("_rank", "spare", "home")


def _bounded(pairs: DataFrame, sketches: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "xa", "xb")), strict=True):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                size = min(len(u), len(v))
                apart = int(np.bitwise_count(folded(u, size) ^ folded(v, size)).sum())
                keep.append(apart <= differing(m + n, threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        own = sketches.select(F.col("doc_id").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("sketch").alias(f"x{side}"))
        pairs = look_up(pairs, own, [side])
    fits = 100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb")
    return pairs.filter(fits).select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, bodies: DataFrame, threshold: int) -> DataFrame:
    """The pairs that link, by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            left = shingle_sets(batch.column("ta"))
            right = (s for part in slices([batch], "tb") for s in shingle_sets(part.column("tb")))
            keep = [similar(x, y, threshold) for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        pairs = look_up(pairs, bodies.select(F.col("doc_id").alias(side), F.col("text").alias(f"t{side}")), [side])
    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def _blocks(rows: DataFrame, weight: str, carried: list[str]) -> DataFrame:
    """Rows (sign, doc_id, component, top, ...) of each bucket dealt to blocks (sign, i, j), and sorted.

    Side 0 holds the rows outside the top component, side 1 all; any two of them meet in one block. A
    side of a block takes BLOCK_BYTES by ``weight`` on average.
    """
    rows = rows.withColumn("_out", F.col("component") != F.col("top"))
    sizes = rows.groupBy("sign").agg(
        *[
            F.ceil(F.sum(F.when(which, F.expr(weight))) / BLOCK_BYTES).cast("int").alias(name)
            for name, which in (("_i", F.col("_out")), ("_j", F.lit(True)))
        ]
    )
    rows = look_up(rows, sizes, ["sign"])
    spread = F.xxhash64("doc_id")

    def side(number: int, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        chosen = rows.filter("_out") if number == 0 else rows
        return chosen.select(
            "sign", "doc_id", "component", *carried, F.lit(number).alias("side"),
            F.pmod(spread, F.col(own)).cast("int").alias(names[0]),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1]),
        ).select("sign", "i", "j", "side", "doc_id", "component", *carried)

    keys = ["sign", "i", "j"]
    both = side(0, "_i", "_j", ("i", "j")).unionByName(side(1, "_j", "_i", ("j", "i")))
    dealt = both.repartition(shuffle_partitions(rows.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys, "side", "doc_id")


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[dict]]]:
    """The two sides of each block of sorted rows, one block at a time."""
    key, sides = None, ([], [])
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["sign"], row["i"], row["j"])
            if now != key:
                if sides[0] and sides[1]:
                    yield sides
                key, sides = now, ([], [])
            own = sides[row["side"]]
            if not own or own[-1]["doc_id"] != row["doc_id"]:  # repeated rows stand together
                own.append(row)
    if sides[0] and sides[1]:
        yield sides


def _near(xs: list[dict], ys: list[dict], threshold: int) -> Iterator[tuple[dict, np.ndarray]]:
    """For each x, the places of those ys of other components that sizes and sketches allow, best first."""
    lanes = min(len(r["sketch"]) for r in xs + ys) // 8
    left, right = (np.stack([folded(np.frombuffer(r["sketch"], np.uint64), lanes) for r in rows]) for rows in (xs, ys))
    of, n = (np.array([r[c] for r in ys], np.int64) for c in ("component", "n_shingles"))
    for x, own in zip(xs, left, strict=True):
        m = x["n_shingles"]
        apart = np.bitwise_count(right ^ own).sum(1, dtype=np.int64)
        fits = (100 * np.minimum(n, m) >= threshold * np.maximum(n, m)) & (of != x["component"])
        at = np.flatnonzero(fits & (apart <= (n + m) * (100 - threshold) // (100 + threshold)))
        yield x, at[np.argsort(apart[at], kind="stable")]


def _suspects(rows: DataFrame, threshold: int) -> DataFrame:
    """(sign, doc_id) of what the bound leaves a partner in another component of its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for xs, ys in _each_block(batches):
            found = set()
            for x, near in _near(xs, ys, threshold):
                if len(near):
                    found.add(x["doc_id"])
                    found.update(ys[j]["doc_id"] for j in near.tolist())
            if found:
                yield pa.RecordBatch.from_pydict({"sign": [xs[0]["sign"]] * len(found), "doc_id": list(found)})

    dealt = _blocks(rows, "octet_length(sketch) + 64", ["n_shingles", "sketch"])
    return dealt.mapInArrow(run, "sign bigint, doc_id bigint").distinct()


def _block_links(rows: DataFrame, threshold: int) -> DataFrame:
    """Links between components of a bucket, at least one from each set to each component it touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shingles(row: dict) -> np.ndarray:
            if "set" not in row:
                row["set"] = next(shingle_sets(pa.array([row["text"]], pa.large_string())))
            return row["set"]

        for xs, ys in _each_block(batches):
            links = []
            for x, near in _near(xs, ys, threshold):
                joined = set()
                for j in near.tolist():
                    # One link to a component is enough: the others change nothing.
                    if ys[j]["component"] not in joined and similar(shingles(x), shingles(ys[j]), threshold):
                        joined.add(ys[j]["component"])
                        links.append((x["doc_id"], ys[j]["doc_id"]))
            if links:
                yield pa.RecordBatch.from_pydict({"a": [a for a, _ in links], "b": [b for _, b in links]})

    dealt = _blocks(rows, "16 * n_shingles + octet_length(text) + 64", ["n_shingles", "sketch", "text"])
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _rest(members: DataFrame, links: DataFrame, sketches: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """Links that the comparisons with the pivots cannot have shown."""
    label = components(links).withColumnRenamed("id", "doc_id")
    # Where no set was settled apart, all were compared with the pivot.
    rows = look_up(members.filter((F.col("doc_id") != F.col("pivot")) | (F.col("cost") >= FREQUENT)), label, ["doc_id"])
    rows = rows.select("sign", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    groups = rows.groupBy("sign", "component").agg(F.count(F.lit(1)).alias("n"))
    open_ = groups.groupBy("sign").agg(F.max_by("component", "n").alias("top"), F.count(F.lit(1)).alias("n"))
    rows = look_up(rows, open_.filter("n > 1").drop("n"), ["sign"]).filter("top is not null")
    rows = stored(look_up(rows, sketches, ["doc_id"]), "open-members")
    suspects = stored(_suspects(rows, threshold), "suspects")
    rows = look_up(rows, suspects.withColumn("suspect", F.lit(True)), ["sign", "doc_id"]).filter("suspect")
    return _block_links(look_up(rows, _bodies(docs, suspects.select("doc_id")), ["doc_id"]), threshold)


def _bodies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text) of the wanted ids, once each."""
    chosen = look_up(docs, wanted.distinct(), ["doc_id"], "left_semi")
    return chosen.groupBy("doc_id").agg(F.first("text").alias("text"))


def join_classes(docs: DataFrame, threshold: int) -> DataFrame:
    """doc_id, n_shingles, component_id of (doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(shuffle_partitions(docs.sparkSession), -(-size // PART_BYTES))
    dealt = _dealt(docs, threshold, tasks * PARTS_A_TASK).repartition(tasks, "part")
    found = stored(_met(dealt), "met")

    documents = found.filter("sign is null").select("doc_id", "n_shingles", "set_key", "sketch")
    filled = documents.filter("n_shingles > 0")
    firsts = filled.groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    classes = look_up(documents.drop("sketch"), firsts, ["set_key"]).drop("set_key")
    classes = stored(classes, "classes")
    reps = classes.filter("doc_id = first_id").select("doc_id").distinct()
    sketches = look_up(filled.drop("set_key").dropDuplicates(["doc_id"]), reps, ["doc_id"], "left_semi")
    sketches = stored(sketches, "sketches")

    members = found.filter("sign is not null").select("doc_id", "sign", "pivot", "home", "spare", "cost")
    members = stored(_allocated(look_up(members, reps, ["doc_id"], "left_semi")), "members")

    star = members.filter("doc_id <> pivot").select(F.col("doc_id").alias("a"), "pivot").distinct()
    copies = classes.filter("doc_id <> first_id").select(F.col("doc_id").alias("pivot"), "first_id").distinct()
    star = look_up(star, copies, ["pivot"]).select("a", F.coalesce("first_id", "pivot").alias("b"))
    pairs = stored(_bounded(star.filter("a <> b").distinct(), sketches, threshold), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    links = stored(_verified(pairs, _bodies(docs, wanted), threshold), "links")
    more = stored(_rest(members, links, sketches, docs, threshold), "more-links")
    labels = components(links.unionByName(more)).select(F.col("id").alias("first_id"), "component")
    return look_up(classes, labels, ["first_id"]).select(
        "doc_id", "n_shingles", F.coalesce("component", "first_id", "doc_id").alias("component_id")
    )


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Documents are linked if 100 * intersection >= ``threshold`` * union of their sets of shingles
    (:mod:`shingles`); component_id is the least id reachable over links, the document itself
    included. No link is lost. NULL, empty and blank texts have no shingles and are linked with nothing.
    Ids are integers that name a text each: repeated rows all come out alike. Rows with a NULL id get
    n_shingles, a NULL component_id, and are linked with nothing. An empty table gives no row.
    """
    rows = texts(docs, id_col, text_col)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = pa.array([len(s) for s in shingle_sets(batch.column("text"))], pa.int64())
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, counts, none], ["doc_id", "n_shingles", "component_id"])

    unnamed = rows.filter("doc_id is null").select("text")
    unnamed = unnamed.mapInArrow(sizes, "doc_id bigint, n_shingles bigint, component_id bigint")
    named = rows.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return join_classes(named, threshold).unionByName(unnamed)
