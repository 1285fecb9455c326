"""Repair of conversations against a plain dynamic program and against trying every edit."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest

from fleetwarden.llm import repair as rp
from fleetwarden.llm.queries import QUERIES
from tests.llm.conftest import clashing

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """{conv_id: result} by a backward dynamic program over whole strings."""
    found = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub(r"[.!?]", "", text)}.get(kind, text)
        found[c] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: conversation(sorted(v, key=lambda r: (r[0], r[1], r[2], r[3].encode()))) for c, v in found.items()}


def conversation(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    turns = [t for given, t, _, _ in rows if given]
    initials = [r[2][:1] for r in rows]
    cost, audit = cheapest([(i, f) for i, f in zip(initials, faults, strict=True)])
    lines, before, left = [], "", list(audit)
    for _, _, role, text in [*rows, (None,) * 4]:
        while left and left[0] == "I":
            left.pop(0)
            lines.append(("assistant" if before == "u" else "user", ""))
            before = lines[-1][0][:1]
        if left and role is not None:
            edit = left.pop(0)
            if edit != "D":
                lines.append((role if edit == "K" else "assistant" if before == "u" else "user", text))
                before = lines[-1][0][:1]
    assert FORM.fullmatch("".join(r[:1] for r, _ in lines))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    best = {0: (0, ""), 3: (0, "")}

    def inserts(best):
        for _ in range(4):
            for (p, c), q in STEP.items():
                if c != "s" and q in best:
                    way = (best[q][0] + 2, "I" + best[q][1])
                    best[p] = min(best.get(p, way), way)
        return best

    best = inserts(best)
    for initial, fault in reversed(rows):
        now = {p: (best[p][0] + 3, "D" + best[p][1]) for p in best}
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            for (p, c), q in STEP.items():
                for price, edit, fits in ((0, "K", c == initial), (2, "R", c in "ua")):
                    if fits and q in best:
                        way = (best[q][0] + price + extra, edit + best[q][1])
                        now[p] = min(now.get(p, way), way)
        best = inserts(now)
    return best[0]


def every_way(rows, inserts):
    """The cheapest of all edit strings with at most ``inserts`` insertions in one place."""
    out = []

    def go(i, made, cost, audit):
        for k in range(inserts + 1):
            for chosen in itertools.product("ua", repeat=k):
                after, price = made + "".join(chosen), cost + 2 * k
                text = audit + "I" * k
                if i == len(rows):
                    if FORM.fullmatch(after):
                        out.append((price, text))
                    continue
                initial, fault = rows[i]
                go(i + 1, after, price + 3, text + "D")
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    go(i + 1, after + (initial or "-"), price + extra, text + "K")
                    for c in "ua":
                        go(i + 1, after + c, price + 2 + extra, text + "R")

    go(0, "", 0, "")
    return min(out)


def test_plain_version_against_every_way():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(4))]
        assert cheapest(rows) == every_way(rows, 2), rows


def symbols(rows):
    return "".join(
        "X" if f in ("blank", "duplicate") else (i if i in "sua" else "o").upper() if f else i if i in "sua" else "o"
        for i, f in rows
    )


def test_matrices_of_rules_equal_the_plain_version():
    rng = random.Random(7)
    rules = []
    for i in range(40):
        known = "suaoSUAOX" + "".join(chr(rp._FIRST_RULE + j) for j in range(i))
        rules.append(rng.choice(known) + rng.choice(known[-12:]))
    ropes, matrices = rp.evaluate(rules)
    for _ in range(150):
        rows = [(rng.choice("suat"), rng.choice(["", "", "truncated", "blank"])) for _ in range(rng.randrange(1, 40))]
        left = rp.rewritten(symbols(rows), rules)
        total = matrices[left[0]]
        for c in left[1:]:
            total = rp.product(ropes, total, matrices[c])
        ends = [(s, t) for s, t in ((0, ""), (0, "II"), (1, "II"), (2, "I"), (3, "")) if total[0][s]]
        assert min((total[0][s][0] + 2 * len(t), ropes.text(total[0][s][1]) + t) for s, t in ends) == cheapest(rows)


def test_ropes_compare_like_strings():
    rng = random.Random(1)
    ropes = rp.Ropes()
    leaves = [ropes.leaf("".join(rng.choice("DK") for _ in range(rng.randrange(4)))) for _ in range(8)]
    for _ in range(200):
        leaves.append(ropes.join(rng.choice(leaves), rng.choice(leaves[:40])))
    for _ in range(800):
        a, b = rng.choice(leaves), rng.choice(leaves)
        assert ropes.less(a, b) == (ropes.text(a) < ropes.text(b))


def got(df):
    return {r[0]: tuple(r)[1:] for r in rp.repair(df).collect()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()} == plain(rows)


@pytest.fixture
def odd_rows():
    rng = random.Random(11)
    words = ["Yes.", "no", "Why?", "", " \t", None, "Größe 漢字!", "one\ntwo", "Yes.", "a. "]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ua"]
    out = []
    for conv in [*range(30), None]:
        for _ in range(rng.randrange(0, 14)):
            out.append((conv, rng.choice([None, *range(-2, 9)]), rng.choice(roles[: 3 + conv % 6 if conv else 3]), rng.choice(words)))
    return out + out[:25] + [(99, t, r, f"line {t}.") for t in range(60) for r in ("user", "assistant")]


def test_odd_rows_in_many_chunks(spark, odd_rows, monkeypatch):
    df = clashing(spark.createDataFrame(odd_rows, SCHEMA))
    want = plain(odd_rows)
    assert got(df) == want
    small = {"CHUNK": 3, "FOLD": 2}  # set in the tasks too: the functions are pickled with their module's values
    for name, value in small.items():
        monkeypatch.setattr(rp, name, value)
    assert got(df) == want


def test_empty_table_and_rows_that_all_go(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert got(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA)) == {
        gone: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    }


def test_grammar_shares_what_repeats(spark):
    strings = spark.createDataFrame([("sua" * k + "ua" * k,) for k in range(1, 30)], "symbols string")
    rules = rp.grammar(strings)
    assert "ua" in rules and len(rules) > 4
    assert max(len(rp.rewritten("sua" * k + "ua" * k, rules)) for k in range(1, 30)) < 30


def test_long_conversation_is_spread(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(12_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = rp._chunks(rp._with_faults(rp.damaged(df))).select("part").distinct().count()
    assert parts > 3
    assert got(df) == plain(rows)
