import random
import re
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetwarden.llm import near_dedup as nd
from fleetwarden.llm.components import components
from fleetwarden.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows):
    """doc_id -> (n_shingles, component_id) by comparing every pair."""
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def near(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_dedup(df).collect()}


@given(st.lists(st.text(alphabet="aB \t\nä漢.\x00\x1c", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_sets(texts):
    got = list(shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in got] == [len(plain_set(t)) for t in texts]
    for a, x in zip(texts, got, strict=True):
        for b, y in zip(texts, got, strict=True):
            assert len(np.intersect1d(x, y)) == len(plain_set(a) & plain_set(b))


def test_very_long_words_and_texts():
    texts = ["x" * 3_000_000, "y " * 1_500_000, "a b c d e " * 300_000]
    assert [len(s) for s in shingle_sets(pa.array(texts))] == [1, 1, 5]


def test_estimate_is_unbiased():
    generator = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.75, 0.9):
        errors = []
        for _ in range(60):
            common = int(2 * 300 * share / (1 + share))
            x = generator.integers(0, 1 << 63, 600 - common, dtype=np.uint64)
            a, b = np.sort(x[:300]), np.sort(x[300 - common :])
            la, lb = nd.minima(a), nd.minima(b)
            equal = ((la ^ lb) & np.uint64(15) == 0).sum()
            errors.append((equal / nd.HASHES - 1 / 16) / (15 / 16) - common / (600 - common))
        assert abs(np.mean(errors)) < 0.02


def test_packed_matches_are_counted(spark):
    generator = np.random.default_rng(6)
    a, b = (generator.integers(0, 1 << 63, nd.HASHES, dtype=np.uint64) & np.uint64(3) for _ in range(2))
    df = spark.createDataFrame([(nd.signature(a).tolist(), nd.signature(b).tolist())], "a array<bigint>, b array<bigint>")
    assert df.select(nd.matches("a", "b")).first()[0] == int((a == b).sum())


def edited(generator, words, share):
    out = list(words)
    for _ in range(int(len(words) * share)):
        out[generator.randrange(len(out))] = f"n{generator.randrange(10**9)}"
    return " ".join(out)


def test_groups_against_every_pair(spark):
    generator = random.Random(3)
    rows, i = [], 0
    for _ in range(25):
        base = [f"w{generator.randrange(10**6)}" for _ in range(generator.choice([1, 3, 5, 8, 60, 300]))]
        for _ in range(generator.choice([1, 2, 9])):
            rows.append((i := i + 1, edited(generator, base, generator.choice([0, 0.01, 0.02, 0.04, 0.08]))))
    rows += [(i + 1, None), (i + 2, ""), (i + 3, " \n"), (i + 4, rows[0][1].upper())]
    generator.shuffle(rows)
    assert near(spark, rows) == plain(rows)


def test_a_large_group_at_the_threshold(spark):
    """Copies of one text so far from it that many reach it only over others."""
    generator = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, edited(generator, base, generator.uniform(0, 0.06))) for k in range(250)]
    assert near(spark, rows) == plain(rows)


def test_links_past_the_pivot(spark):
    """a-b and b-c are linked, a-c is not, and the least id is not the middle one."""
    words = [f"w{k}" for k in range(100)]
    other = words[:10] + [f"x{k}" for k in range(8)] + words[18:]
    third = words[:10] + [f"x{k}" for k in range(8)] + words[18:60] + [f"y{k}" for k in range(8)] + words[68:]
    rows = [(1, " ".join(third)), (2, " ".join(words)), (3, " ".join(other))]
    assert plain(rows)[2] == (96, 1) and near(spark, rows) == plain(rows)


def test_blocks_of_any_size_find_the_same(spark, monkeypatch):
    generator = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = [(k, edited(generator, base, generator.uniform(0, 0.07))) for k in range(80)]
    monkeypatch.setattr(nd, "BLOCK_BYTES", 1 << 12)
    assert near(spark, rows) == plain(rows)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(100, 160)] + [(7, 5), (5, 9), (3, 3), (500, 160), (1000, 1001)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {5: 5, 7: 5, 9: 5, 500: 100, 1000: 1000, 1001: 1000}


def test_odd_tables(odd, none):
    got = nd.near_dedup(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and not by[2].kept and by[7].component_id == 6
    assert by[3].kept and by[3].n_shingles == 0 and by[None].component_id is None and by[None].kept
    left = nd.drop_near_copies(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect() if r.doc_id is not None)) == [1, 3, 4, 5, 6, 8]
    assert nd.near_dedup(none).count() == 0


def test_floor():
    assert nd.least_matches() < nd.HASHES * 0.7 < nd.HASHES
    with pytest.raises(TypeError):
        nd.least_matches("x")


def test_floor_keeps_pairs_without_chance_matches():
    floor = nd.least_matches()
    tail = [Fraction(comb(nd.HASHES, k) * 3**k, 4**nd.HASHES) for k in range(floor + 1)]
    assert sum(tail[:floor]) <= Fraction(1, 3_000_000) < sum(tail)


def test_chance_matches_differ_by_hash_function():
    generator = np.random.default_rng(11)
    sets = generator.integers(1, 1 << 63, (200, 1), dtype=np.uint64)
    groups = [nd.signature(nd.minima(s)).view(np.uint64)[:, None] >> np.arange(0, 64, 4, dtype=np.uint64) & np.uint64(15) for s in sets]
    found = [int((a == b).sum()) for a, b in zip(groups[::2], groups[1::2], strict=True)]
    assert 1 <= min(found) and max(found) <= 45 and 13 < sum(found) / len(found) < 19
