"""SentencePiece encoding and decoding with the N best segmentations.

A text's lattice has an arc for every vocabulary piece that matches. Forward Viterbi gives each
position the score of the best way there; a backward A* search from the end uses these scores as its
heuristic, which is exact, so that paths come out best first and nothing is searched in vain.

The lattice falls apart into units where no piece can cross: mostly words. Each worker searches a
unit once while it is remembered, and the N best of a text follow from those of its units: only the
N - 1 occurrences whose second choice costs least can differ from the best path.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwarden.llm.common import packed, slices, text_of

CACHE_SIZE = 1 << 18  # units in each of a worker's two generations of remembered units: 180 MB in all
# Where whole rows go through the worker it remembers this part of them: 25 MB.
BESIDE_ROWS = 8
SPACE = "▁"
LETTER = r"\p{L}\p{M}"
_NOTHING: dict = {}


@lru_cache(maxsize=1)
def _letters() -> str:
    """LETTER up to U+FFFF as ranges, for the standard library's patterns, which know no properties."""
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    runs = [m.span() for m in regex.finditer(f"[{LETTER}]+", chars)]
    ranges: list[str] = []
    for start, end in runs:
        cuts = [start, *(i for i in range(start + 1, end) if ord(chars[i]) != ord(chars[i - 1]) + 1), end]
        ranges.extend(f"\\u{ord(chars[a]):04x}-\\u{ord(chars[b - 1]):04x}" for a, b in zip(cuts, cuts[1:], strict=False))
    return "".join(ranges)


class Path(NamedTuple):
    """One segmentation: its score and its ids as little-endian 32-bit numbers."""

    score: float
    ids: bytes


class Pieces:
    """The pieces of a model file as a lattice, with this worker's remembered units."""

    def __init__(self, path: str, nbest: int, part: int = 1):
        from sentencepiece import SentencePieceProcessor

        self.nbest, self.part = nbest, part
        self.processor = sp = SentencePieceProcessor(model_file=path)
        skip = [sp.is_control, sp.is_unknown, sp.is_unused, sp.is_byte]
        usual = [i for i in range(sp.get_piece_size()) if not any(f(i) for f in skip)]
        self.arcs: dict[str, tuple[float, int]] = {sp.id_to_piece(i): (sp.get_score(i), i) for i in usual}
        # What some piece begins with, so that a search knows where no longer piece can follow.
        # Minus infinity: no piece itself. Likewise what some piece ends with, for the way back.
        heads = {p[:i]: -np.inf for p in self.arcs for i in range(1, len(p))}
        self.tails = {p[i:] for p in self.arcs for i in range(len(p))}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_known = all(sp.is_byte(i) for i in self.byte_ids)
        # A character without a piece costs more than any that has one, as in the library.
        # (Scores of -1e9 mark placeholders for runs of spaces.)
        self.unknown = min(s for p, (s, _) in self.arcs.items() if len(p) == 1 and s > -1e8) - 10
        heads.update((p, self.unknown) for p in [h for h in heads if len(h) == 1])
        heads.update((p, score) for p, (score, _) in self.arcs.items())
        # As a tree: character -> (score, the tree of what follows).
        follow: dict[str, dict[str, tuple[float, dict]]] = {}
        for p in sorted(heads, key=len, reverse=True):
            follow.setdefault(p[:-1], {})[p[-1]] = (heads[p], follow.pop(p, _NOTHING))
        self.heads = follow.get("", _NOTHING)
        self.raw = [sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(sp.get_piece_size())]
        for value, i in enumerate(self.byte_ids if self.bytes_known else []):
            self.raw[i] = bytes([value])
        for i in range(sp.get_piece_size()):
            if sp.is_control(i):
                self.raw[i] = b""
        self.unit = self._unit_pattern()
        # The same for texts without characters above U+FFFF: takes less than half the time.
        self.short_unit = re.compile(self.unit.pattern.replace(LETTER, _letters()))
        self.new: dict[str, tuple[float, bytes, float]] = {}
        self.old: dict[str, tuple[float, bytes, float]] = {}

    def _unit_pattern(self) -> regex.Pattern:
        """Cuts a normalised text where no piece crosses.

        Before a run of spaces, after a run of letters, and around ASCII characters that are in no
        longer piece: each as far as the vocabulary allows it.
        """
        longer = [p for p in self.arcs if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return regex.compile(r"(?s).+")
        used = set("".join(longer))
        alone = "".join(regex.escape(chr(c)) for c in range(128) if chr(c) not in used)
        glued = {m for p in longer for m in regex.findall(r"(?<=[\p{L}\p{M}])[^\p{L}\p{M}]", p)}
        if glued:  # what follows a letter in some piece may be followed by anything
            return regex.compile(f"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        letter, single = LETTER, f"[{alone}]|" if alone else ""
        return regex.compile(f"(?s){single}{SPACE}*[^{SPACE}{letter}{alone}]*[{letter}]+|{SPACE}*[^{SPACE}{letter}{alone}]+|{SPACE}+")

    def _fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode()) if self.bytes_known else (self.processor.unk_id(),)

    def _forward(self, unit: str) -> tuple[list[float], list[float], list[int]]:
        """Viterbi: for each position the best score there, that of the best other last piece, and
        where the best one's last piece begins."""
        n, heads, lone = len(unit), self.heads, (self.unknown, _NOTHING)
        best, other, back = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1), [0] * (n + 1)
        for begin in range(n):
            so_far, follow, end = best[begin], heads, begin
            for char in unit[begin:]:
                found = follow.get(char)
                if found is None:
                    if end > begin:
                        break
                    found = lone
                score, follow = found
                end += 1
                way = so_far + score
                if way > other[end]:
                    if way > best[end]:
                        other[end], best[end], back[end] = best[end], way, begin
                    else:
                        other[end] = way
        return best, other, back

    def search(self, unit: str, nbest: int) -> list[Path]:
        """The ``nbest`` best segmentations, best first; equal scores in search order."""
        best, unknown = self._forward(unit)[0], self.unknown
        arcs, tails, push, pop = self.arcs, self.tails, heapq.heappush, heapq.heappop
        # (-(score behind + best score before), order, position, score behind, piece, what follows)
        heap: list = [(-best[-1], 0, len(unit), 0.0, None, None)]
        order, found = 0, []
        while heap and len(found) < nbest:
            entry = pop(heap)
            position, behind = entry[2], entry[3]
            if position == 0:
                ids: list[int] = []
                while entry[4] is not None:
                    ids.extend(self._ids(entry[4]))
                    entry = entry[5]
                found.append(Path(behind, struct.pack(f"<{len(ids)}i", *ids)))
                continue
            for begin in range(position - 1, -1, -1):
                tail = unit[begin:position]
                known = tail in tails
                if known or begin == position - 1:
                    arc = arcs.get(tail)
                    if arc is not None or begin == position - 1:
                        order -= 1
                        score = behind + (unknown if arc is None else arc[0])
                        push(heap, (-(score + best[begin]), order, begin, score, tail, entry))
                if not known:
                    break
        return found

    def _ids(self, piece: str) -> tuple[int, ...]:
        arc = self.arcs.get(piece)
        return (arc[1],) if arc else self._fallback(piece)

    def first(self, unit: str) -> tuple[float, bytes, float]:
        """Score and ids of a unit's best segmentation, and what the second loses on it.

        The second best leaves the best way at some position, seen from the end, by another last
        piece; so the forward scores alone tell its loss, and only units that matter are searched.
        Remembered: when one generation is full, the one before is dropped.
        """
        found = self.new.get(unit)
        if found is None:
            found = self.old.get(unit)
            if found is None:
                best, other, back = self._forward(unit)
                arcs, ids, loss, at = self.arcs, [], np.inf, len(unit)
                while at:
                    if best[at] - other[at] < loss:
                        loss = best[at] - other[at]
                    piece = unit[back[at] : at]
                    arc = arcs.get(piece)
                    if arc:
                        ids.append(arc[1])
                    else:
                        ids.extend(reversed(self._fallback(piece)))
                    at = back[at]
                ids.reverse()
                found = (best[-1], struct.pack(f"<{len(ids)}i", *ids), loss)
            if len(self.new) >= CACHE_SIZE // self.part:
                self.old, self.new = self.new, {}
            self.new[unit] = found
        return found

    def units(self, text: str) -> list[str]:
        """The units of a normalised text, in order."""
        short = len(text.encode("utf-16-le")) == 2 * len(text)
        return (self.short_unit if short else self.unit).findall(text)

    def encode(self, text: str) -> list[Path]:
        """The N best segmentations of a whole text; equal scores: earlier changes first."""
        units = self.units(self.processor.normalize(text)) if text else []
        counts = Counter(units)
        spare, total = self.nbest - 1, 0.0
        ids: dict[str, bytes] = {}
        cheap: list[tuple[float, int, str]] = []  # the cheapest changes, as a heap of the dearest first
        worst, get = np.inf if spare else -np.inf, self.new.get
        for place, (unit, count) in enumerate(counts.items()):
            score, own, loss = get(unit) or self.first(unit)
            ids[unit] = own
            total += score * count
            if loss < worst:
                heapq.heappush(cheap, (-loss, -place, unit))
                if len(cheap) > spare:
                    heapq.heappop(cheap)
                if len(cheap) == spare:
                    worst = -cheap[0][0]
        best = list(map(ids.__getitem__, units))
        found = [Path(total, b"".join(best))]
        places: list[tuple[float, int]] = []
        for loss, _, unit in cheap:
            at = -1
            for _ in range(min(spare, counts[unit])):
                at = units.index(unit, at + 1)
                places.append((-loss, at))
        # (lost on the best path, changes made as (place, ids))
        choices: list[tuple[float, tuple[tuple[int, bytes], ...]]] = [(0.0, ())]
        for _, at in sorted(places)[:spare]:
            score, own, _ = self.first(units[at])
            ways = [way for way in self.search(units[at], self.nbest) if way.ids != own][:spare]
            more = [(loss + score - way.score, (*made, (at, way.ids))) for loss, made in choices for way in ways]
            choices = sorted(choices + more, key=lambda x: x[0])[: self.nbest]
        for loss, made in choices[1:]:
            changed = best.copy()
            for at, other in made:
                changed[at] = other
            found.append(Path(total - loss, b"".join(changed)))
        return found

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        joined = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        text = joined.decode("utf-8", "replace")
        return text.removeprefix(" ")


@lru_cache(maxsize=4)
def pieces(path: str, nbest: int, part: int = 1) -> Pieces:
    return Pieces(path, nbest, part)


def encode_nbest(docs: DataFrame, path: str, nbest: int = 3, text_col: str = "text") -> DataFrame:
    """The input rows as ``row`` (a struct, whatever their columns) with ``paths`` and ``decoded``.

    ``paths`` holds up to ``nbest`` segmentations (score, ids), best first; ``decoded`` is the text of
    the best one. Scores are sums of the model's piece scores; a character without a piece scores 10
    less than the worst one-character piece and is written as its UTF-8 bytes. NULL and empty texts
    have one empty segmentation with score 0. A text comes back unchanged unless it holds U+2581
    (which comes back as a space) or NUL (where the library's normaliser decides). ``path`` is a model
    file that every worker can read.
    """
    rows = packed(docs.withColumn(text_col, F.col(text_col).cast("string")), "row")
    place = docs.columns.index(text_col)

    def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The text once more as a column of its own, without a copy of it."""
        row = batch.column("row")
        return pa.RecordBatch.from_arrays([row, row.flatten()[place]], ["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path, nbest, BESIDE_ROWS)
        for batch in slices(map(with_text, batches), "text"):
            scores, ids, sizes, decoded = [], [], [], []
            for text in batch.column("text"):
                found = own.encode(text.as_py() or "")
                decoded.append(own.decode(found[0].ids))
                scores.extend(p.score for p in found)
                ids.extend(np.frombuffer(p.ids, "<i4") for p in found)
                sizes.append(len(found))
            ends = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            path_ = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), lists], ["score", "ids"])
            paths_ = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), path_)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), paths_, pa.array(decoded, pa.string())], ["row", "paths", "decoded"]
            )

    made = T.StructType(
        [
            rows.schema["row"],
            T.StructField("paths", T.ArrayType(T.StructType().add("score", "double").add("ids", T.ArrayType(T.IntegerType())))),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, made)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the column ``decoded``: the text of an array of ids; NULL is the empty text."""

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        own = pieces(path, 1)
        lists = [np.array(x.as_py() or [], "<i4").tobytes() for x in column]
        return pa.array([own.decode(x) for x in lists], pa.string())

    return rows.withColumn("decoded", decoded(F.col(ids_col)))


def nbest_digests(
    docs: DataFrame, path: str, nbest: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_pieces, and for each rank score and SHA-256 of the ids.

    The digest columns of :func:`encode_nbest`, made where the text is encoded, so that the ids of a
    corpus need not be written: n_paths, scores, ids_sha256 (of little-endian 32-bit ids),
    round_trip (the best segmentation decodes to the text).
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path, nbest)
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for text in batch.column("text").to_pylist():
                found = own.encode(text)
                digests = [hashlib.sha256(p.ids).hexdigest() for p in found]
                same = own.decode(found[0].ids) == text
                out.append((len(found[0].ids) // 4, [p.score for p in found], digests, same))
            n, scores, digests, same = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(scores, pa.list_(pa.float64())),
                    pa.array(digests, pa.list_(pa.string())),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "n_pieces", "scores", "ids_sha256", "round_trip"],
            )

    kinds = "doc_id bigint, n_pieces bigint, scores array<double>, ids_sha256 array<string>, round_trip boolean"
    return rows.mapInArrow(run, kinds)
