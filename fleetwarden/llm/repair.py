"""Repair of conversation structure by dynamic programming over a grammar of edit problems.

Every row of a conversation becomes one symbol: the class of its role and its fault. A chunk of rows
is a string of symbols, and equal strings are one. Re-Pair rounds over all distinct strings replace
the most frequent pairs of symbols by rules; Spark counts the pairs, and the number of rules is
bounded. Each rule has one min-plus transfer matrix over the states of the wanted form, made from
the matrices of its two symbols, whose entries hold the least cost and a rope of the edits. So a
pattern that many conversations share is solved once; a string is the product of the matrices that
are left in it, and a long conversation the product of its chunks.

The wanted form of the initials of the roles is ``(s?(ua)+)?``. States: 0 nothing yet, 1 after s,
2 after u, 3 after a; 0 and 3 may end. Insertions stand before the row they precede, or at the very
end. So no edit string between two states is a proper prefix of another one for the same rows, and
the least string of a product is the product of least strings.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwarden.llm.common import shuffle_partitions, stored
from fleetwarden.operators.lookup import look_up

STATES = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CHUNK = 4096  # rows of a conversation in one string
FOLD = 16  # chunks whose matrices one step multiplies
RULES, ROUNDS, AT_ONCE = 512, 24, 32
_FIRST_RULE = 0x4E00  # the character of the first rule; symbols are letters

_SPACES = " \\t-\\r"
_BLANK_ROW = "X"  # blank or duplicate: it must go
_STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
# What insertions reach from a state: (state, edits).
_BEFORE = {0: [(0, ""), (2, "I"), (3, "II")], 1: [(1, ""), (2, "I"), (3, "II")], 2: [(2, ""), (3, "I")], 3: [(3, ""), (2, "I")]}


class Ropes:
    """Strings as shared concatenations, compared by descending where their hashes differ."""

    MODULUS, BASE = (1 << 61) - 1, 911_382_323

    def __init__(self) -> None:
        self.nodes: list[tuple[int, int] | str] = []
        self.sizes: list[int] = []
        self.hashes: list[int] = []
        self.powers: list[int] = []  # BASE ** size

    def leaf(self, text: str) -> int:
        value = 0
        for c in text:
            value = (value * self.BASE + ord(c)) % self.MODULUS
        return self._add(text, len(text), value, pow(self.BASE, len(text), self.MODULUS))

    def join(self, a: int, b: int) -> int:
        value = (self.hashes[a] * self.powers[b] + self.hashes[b]) % self.MODULUS
        return self._add((a, b), self.sizes[a] + self.sizes[b], value, self.powers[a] * self.powers[b] % self.MODULUS)

    def _add(self, node: tuple[int, int] | str, size: int, value: int, power: int) -> int:
        self.nodes.append(node)
        self.sizes.append(size)
        self.hashes.append(value)
        self.powers.append(power)
        return len(self.nodes) - 1

    def cut(self, size: int) -> None:
        """Forget the nodes added since there were ``size``."""
        for column in (self.nodes, self.sizes, self.hashes, self.powers):
            del column[size:]

    def text(self, rope: int) -> str:
        parts, open_ = [], [rope]
        while open_:
            node = self.nodes[open_.pop()]
            if isinstance(node, str):
                parts.append(node)
            else:
                open_ += [node[1], node[0]]
        return "".join(parts)

    def less(self, a: int, b: int) -> bool:
        """Whether a's text comes before b's."""
        if self.sizes[a] == self.sizes[b] and self.hashes[a] == self.hashes[b]:
            return False
        xs, ys = [a], [b]
        while xs and ys:
            x, y = xs[-1], ys[-1]
            if self.sizes[x] == self.sizes[y] and self.hashes[x] == self.hashes[y]:
                xs.pop()
                ys.pop()
                continue
            p, q = self.nodes[x], self.nodes[y]
            if not isinstance(p, str) and (isinstance(q, str) or self.sizes[x] >= self.sizes[y]):
                xs[-1:] = [p[1], p[0]]
            elif not isinstance(q, str):
                ys[-1:] = [q[1], q[0]]
            else:
                n = min(len(p), len(q))
                if p[:n] != q[:n]:
                    return p < q
                for stack, text in ((xs, p), (ys, q)):
                    stack.pop()
                    if text[n:]:
                        stack.append(self.leaf(text[n:]))
        return any(self.sizes[y] for y in ys) and not any(self.sizes[x] for x in xs)


Entry = tuple[int, int] | None  # cost and rope
Matrix = list[list[Entry]]


def product(ropes: Ropes, a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        for q in range(STATES):
            best = None  # cost, the two ropes, their concatenation once it is needed
            for r in range(STATES):
                x, y = a[p][r], b[r][q]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, ropes.join(x[1], y[1]))
                elif cost == best[0]:
                    other = ropes.join(x[1], y[1])
                    if ropes.less(other, best[1]):
                        best = (cost, other)
            out[p][q] = best
    return out


def row_matrix(ropes: Ropes, symbol: str) -> Matrix:
    """All ways to treat one row, with what is inserted before it."""
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    extra = TRUNCATED if symbol.isupper() and symbol != _BLANK_ROW else 0
    role = symbol.lower()
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for p in range(STATES):
        for at, inserted in _BEFORE[p]:
            ways = [(at, DELETE, "D")]
            if symbol != _BLANK_ROW:
                ways += [(_STEP[role][at], KEEP + extra, "K")] if at in _STEP.get(role, {}) else []
                ways += [(_STEP[r][at], REROLE + extra, "R") for r in "ua" if at in _STEP[r]]
            for q, cost, edit in ways:
                way = (cost + INSERT * len(inserted), inserted + edit)
                found[p, q] = min(found.get((p, q), way), way)
    for (p, q), (cost, edits) in found.items():
        out[p][q] = (cost, ropes.leaf(edits))
    return out


def evaluate(rules: list[str]) -> tuple[Ropes, dict[str, Matrix]]:
    """The matrices of all symbols and rules, bottom-up."""
    ropes = Ropes()
    known = {s: row_matrix(ropes, s) for s in "suaoSUAO" + _BLANK_ROW}
    for i, (left, right) in enumerate(rules):
        known[chr(_FIRST_RULE + i)] = product(ropes, known[left], known[right])
    return ropes, known


def rewritten(symbols: str, rules: list[str]) -> str:
    for i, pair in enumerate(rules):
        if len(symbols) < 2:
            break
        symbols = symbols.replace(pair, chr(_FIRST_RULE + i))
    return symbols


def grammar(strings: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[str]:
    """Re-Pair rules (pairs of characters) for the distinct strings of (symbols).

    A round counts the pairs of neighbours in all strings and takes the most frequent ones that have
    no symbol in common, so that one does not change the count of another. Only these few reach the
    driver. The rules only decide what is shared: any grammar gives the same result.
    """
    found: list[str] = []
    for _ in range(rounds):
        known = list(found)

        def run(batches: Iterator[pa.RecordBatch], known: list[str] = known) -> Iterator[pa.RecordBatch]:
            counts: Counter[str] = Counter()
            for batch in batches:
                for symbols in batch.column("symbols").to_pylist():
                    left = rewritten(symbols, known)
                    counts.update(map("".join, zip(left, left[1:])))
            yield pa.RecordBatch.from_pydict({"pair": list(counts), "n": pa.array(counts.values(), pa.int64())}, schema)

        schema = pa.schema([("pair", pa.string()), ("n", pa.int64())])
        pairs = strings.select("symbols").mapInArrow(run, "pair string, n bigint")
        sums = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        used: set[str] = set()
        before = len(found)
        for r in sums.orderBy(F.desc("n"), "pair").limit(AT_ONCE).collect():
            if len(found) < rules and not used & set(r["pair"]):
                found.append(r["pair"])
                used |= set(r["pair"])
        if len(found) == before:
            break
    return found


def solve(strings: DataFrame, rules: list[str]) -> DataFrame:
    """symbols, costs, audits: the transfer matrix of each string, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ropes, known = evaluate(rules)
        base = len(ropes.nodes)
        for batch in batches:
            costs, audits = [], []
            for symbols in batch.column("symbols").to_pylist():
                left = rewritten(symbols, rules)
                total = known[left[0]]
                for c in left[1:]:
                    total = product(ropes, total, known[c])
                cells = [cell for line in total for cell in line]
                costs.append([cell and cell[0] for cell in cells])
                audits.append([cell and ropes.text(cell[1]) for cell in cells])
                ropes.cut(base)
            yield pa.RecordBatch.from_arrays(
                [batch.column("symbols"), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                ["symbols", "costs", "audits"],
            )

    return strings.select("symbols").mapInArrow(run, "symbols string, costs array<bigint>, audits array<string>")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n): the rows after damage, equal ones together with their number."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    out = rows.select(
        # A text even for NULL, so that such rows are one conversation in every join and sort.
        _conv(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    ).filter("n > 0")
    return out.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _conv(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _with_faults(rows: DataFrame) -> DataFrame:
    """blank, duplicate, truncated (of the first of equal rows), initial and symbol."""
    same = ["conv", "role", "digest"]
    rows = rows.withColumn("digest", F.sha2("text", 256))
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    often = rows.groupBy(*same).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    rows = look_up(rows, often.drop("times"), same).withColumn(
        "duplicate", F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    )
    last = F.regexp_extract("text", f"([^{_SPACES}])[{_SPACES}]*\\z", 1)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (
        rows.withColumn("blank", ~F.col("text").rlike(f"[^{_SPACES}]"))
        .withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & ~last.isin(".", "!", "?"))
        .withColumn("initial", initial)
        .withColumn("symbol", F.when(F.col("blank") | F.col("duplicate"), _BLANK_ROW)
                    .when(F.col("truncated"), F.upper(letter)).otherwise(letter))
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_CHUNKS = (
    "conv string, part int, no bigint, symbols string, first_initial string, last_initial string, "
    "first_turn bigint, last_turn bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
)


def illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _chunks(rows: DataFrame) -> DataFrame:
    """Strings of at most CHUNK rows of each conversation, in order, with what counts in them.

    The rows are range-partitioned and sorted, so a conversation of any length is spread over tasks,
    and a task holds one chunk at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        done: list[dict] = []
        now: dict | None = None

        def start(conv: str, turn: int | None, initial: str) -> dict:
            return dict.fromkeys(_COUNTS, 0) | {
                "conv": conv, "symbols": [], "first_initial": initial, "last_initial": None,
                "first_turn": turn, "last_turn": None,
            }

        def flush() -> pa.RecordBatch:
            out = pd.DataFrame(done)
            out["symbols"] = out["symbols"].map("".join)
            done.clear()
            return pa.RecordBatch.from_pandas(out, pa.schema(kinds), preserve_index=False)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "n", "initial", "symbol", "blank", "duplicate", "truncated")]
            for conv, turn, n, initial, symbol, blank, duplicate, truncated in zip(*columns, strict=True):
                for copy in range(n):
                    if now is None or now["conv"] != conv or len(now["symbols"]) >= CHUNK:
                        if now is not None:
                            done.append(now | {"part": part, "no": no})
                            no += 1
                            if len(done) >= 256:
                                yield flush()
                        now = start(conv, turn, initial)
                    now["symbols"].append(_BLANK_ROW if copy else symbol)
                    now["blank"] += blank
                    now["duplicate"] += not blank and (duplicate or copy > 0)
                    now["truncated"] += truncated and not copy
                    now["illegal"] += now["last_initial"] is not None and illegal(now["last_initial"], initial)
                    now["last_initial"] = initial
                    if turn is not None and now["last_turn"] != turn:
                        now["first_turn"] = turn if now["first_turn"] is None else now["first_turn"]
                        now["last_turn"] = turn
                        now["turns"] += 1
        if now is not None:
            done.append(now | {"part": part, "no": no})
        if done:
            yield flush()

    text, number = pa.string(), pa.int64()
    kinds = [("conv", text), ("part", pa.int32()), ("no", number), ("symbols", text), ("first_initial", text),
             ("last_initial", text), ("first_turn", number), ("last_turn", number), *[(c, number) for c in _COUNTS]]
    order = ["conv", "turn", "role", "text"]
    ranged = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    narrow = ranged.select("conv", "turn", "n", "initial", "symbol", "blank", "duplicate", "truncated")
    return narrow.mapInArrow(run, _CHUNKS)


def _fold(parts: DataFrame) -> DataFrame:
    """Neighbouring chunks of a conversation multiplied, FOLD at a time."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        total = None
        for r in group.to_dict("records"):
            cells = [None if a is None else (int(c), a) for c, a in zip(r["costs"], r["audits"], strict=True)]
            r["cells"] = [cells[i : i + STATES] for i in range(0, len(cells), STATES)]
            if total is None:
                total = r
                continue
            ways = [
                [
                    min(((x[0] + y[0], x[1] + y[1]) for x, y in zip(line, column, strict=True) if x and y), default=None)
                    for column in zip(*r["cells"], strict=True)
                ]
                for line in total["cells"]
            ]
            joins = total["last_turn"] is not None and total["last_turn"] == r["first_turn"]
            total |= {c: total[c] + r[c] for c in _COUNTS}
            total["turns"] -= joins
            total["illegal"] += illegal(total["last_initial"], r["first_initial"])
            total["first_turn"] = r["first_turn"] if total["first_turn"] is None else total["first_turn"]
            total["last_turn"] = total["last_turn"] if r["last_turn"] is None else r["last_turn"]
            total |= {"last_initial": r["last_initial"], "cells": ways}
        flat = [cell for line in total["cells"] for cell in line]
        total |= {"place": total["place"] // FOLD, "costs": [c and c[0] for c in flat], "audits": [c and c[1] for c in flat]}
        return pd.DataFrame([{c: total[c] for c in names}])

    names = parts.columns
    return parts.groupBy("conv", F.floor(F.col("place") / FOLD)).applyInPandas(run, parts.schema)


def _combined(chunks: DataFrame) -> DataFrame:
    """One row per conversation from its chunks (conv, part, no, ..., costs, audits)."""
    parts = chunks.groupBy("conv").agg(F.count(F.lit(1)).alias("parts"))
    long_ = parts.filter("parts > 1")
    # As text: pandas would turn long values beside NULLs into doubles.
    chunks = chunks.withColumns({c: F.col(c).cast("string") for c in ("first_turn", "last_turn")})
    rows = stored(look_up(chunks, long_, ["conv"]).drop("symbols"), "chunks")
    single = rows.filter("parts is null").drop("part", "no", "parts").withColumn("place", F.lit(0).cast("bigint"))
    place = F.row_number().over(Window.partitionBy("conv").orderBy("part", "no")) - 1
    many = rows.filter("parts is not null").withColumn("place", place.cast("bigint")).drop("part", "no", "parts")
    many = many.select(*single.columns)
    most = rows.agg(F.max("parts")).first()[0] or 1
    while most > 1:
        many = stored(_fold(many), "folded")
        most = -(-most // FOLD)
    return single.unionByName(many)


def _closing(costs: str, audits: str) -> Column:
    """The cheapest (cost, audit) from state 0 to an end, what is inserted last included."""
    ways = []
    for state, after in ((0, ""), (0, "II"), (1, "II"), (2, "I"), (3, "")):
        cost, audit = F.col(costs)[state] + INSERT * len(after), F.concat(F.col(audits)[state], F.lit(after))
        ways.append(F.when(F.col(audits)[state].isNotNull(), F.struct(cost.alias("cost"), audit.alias("audit"))))
    return F.array_min(F.array_compact(F.array(*ways)))


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv, repaired_sha256: the edits applied, row by row, to the sorted rows of each conversation.

    A conversation's text is one digest, so its rows pass through one task; they stream through it.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edits, at, before, digest, lines = None, "", 0, "", sha256(), 0
        convs, digests = [], []

        def write(role: str, text: str) -> None:
            nonlocal before, lines
            digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            before, lines = role[:1], lines + 1

        def due() -> str:
            return "assistant" if before == "u" else "user"

        def inserts() -> None:
            nonlocal at
            while at < len(edits) and edits[at] == "I":
                write(due(), "")
                at += 1

        def close() -> None:
            inserts()
            convs.append(conv)
            digests.append(digest.hexdigest())

        for batch in batches:
            for key, audit, role, text, n in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if audit is not None:
                    if conv is not None:
                        close()
                    conv, edits, at, before, digest, lines = key, audit, 0, "", sha256(), 0
                    continue
                for _ in range(n):
                    inserts()
                    edit, at = edits[at], at + 1
                    if edit != "D":
                        write(role if edit == "K" else due(), text)
            yield pa.RecordBatch.from_pydict({"conv": convs, "repaired_sha256": digests}, schema)
            convs, digests = [], []
        if conv is not None:
            close()
            yield pa.RecordBatch.from_pydict({"conv": convs, "repaired_sha256": digests}, schema)

    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("n", "bigint"))]
    heads = audits.select("conv", "audit", *nothing, F.lit(0).alias("kind"))
    body = rows.select("conv", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "n", F.lit(1).alias("kind"))
    both = heads.unionByName(body).repartition(shuffle_partitions(rows.sparkSession), "conv")
    sorted_ = both.sortWithinPartitions("conv", "kind", "turn", "role", "text")
    return sorted_.select("conv", "audit", "role", "text", "n").mapInArrow(run, "conv string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows (conv_id, turn, role, text) are first damaged: by crc32(``conv_id:turn``) % 20, 0 drops a
    row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's. NULL counts as
    one space in that key, as role and as text. Rows stand by turn, NULLs first, and rows of one turn by
    role and text; repeated rows are neighbours. The counts are of each row's first fault; ``illegal``
    counts neighbours whose initials are not su, ua or au. ``audit`` holds the cheapest edits that give
    the form ``(s?(ua)+)?``, of equally cheap ones the least string: K keep, R other role, D delete,
    I insert. NULL ids are one conversation; one without rows after the damage has zeros and an empty
    audit; an empty table gives no row. Other columns are not read.
    """
    given = conversations.select("conv_id", "turn", "role", "text")
    rows = stored(damaged(given), "damaged")
    chunks = stored(_chunks(_with_faults(rows)), "chunks")
    strings = stored(chunks.select("symbols").distinct(), "strings")
    solved = stored(solve(strings, grammar(strings)), "solved")
    solved_chunks = look_up(chunks, solved, ["symbols"])
    best = _closing("costs", "audits")
    totals = _combined(solved_chunks).withColumn("best", best)
    totals = stored(
        totals.select(
            "conv", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit",
            F.coalesce(F.col("last_turn").cast("bigint") - F.col("first_turn").cast("bigint") + 1 - F.col("turns"), F.lit(0))
            .alias("gaps"),
        ),
        "totals",
    )
    found = look_up(totals, _digests(rows, totals), ["conv"])
    every = given.select("conv_id").distinct().withColumn("conv", _conv(F.col("conv_id")))
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return look_up(every, found, ["conv"]).select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
