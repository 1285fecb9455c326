"""The Jaccard join against comparing every pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import jaccard_join as jj
from fleetwarden.llm.shingles import mix
from tests.llm.test_near_dedup import plain_set


def plain(rows, threshold=80):
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
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def joined(spark, rows, threshold=80):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_join(df, threshold=threshold).collect()}


def hashes(n, rng):
    return np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))


@pytest.mark.parametrize("threshold", [50, 75, 80, 95])
def test_linked_sets_share_a_signature(threshold):
    """For sets of every size that just link, also where what is most frequent is left out."""
    rng, bands = np.random.default_rng(threshold), jj.Bands(threshold)
    for n in [*range(1, 60), *range(60, 1500, 37)]:
        for _ in range(4):
            a = hashes(n, rng)
            total = n + rng.integers(n, n * 100 // threshold + 1)
            drop = int(rng.integers(0, jj.differing(total, threshold) + 1))
            drop = min(drop, len(a) - 1)
            kept = rng.permutation(a)[drop:]
            more = min(jj.differing(n + len(kept), threshold) - drop, n)
            b = np.unique(np.concatenate([kept, hashes(max(more, 0), rng)]))
            if not jj.similar(a, b, threshold):
                continue
            found = []
            frequent = set(rng.integers(0, 7, 1 << 12).tolist())
            for s in (a, b):
                kept_signs = set()
                for signs, role in jj.signatures(s, mix(s), bands):
                    # A global order of costs, as the counts of the buckets would give it.
                    costly = sorted(signs.tolist(), key=lambda x: (x % 13 in frequent, x), reverse=True)
                    kept_signs |= set(costly[role & jj._SPARE :])
                found.append(kept_signs)
            assert found[0] & found[1], (n, len(b))


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = hashes(int(rng.integers(1, 900)), rng)
        b = np.unique(np.concatenate([rng.permutation(a)[int(rng.integers(0, len(a))) :], hashes(int(rng.integers(0, 400)), rng)]))
        x, y = (np.frombuffer(jj.sketch(mix(s)), np.uint64) for s in (a, b))
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(jj.folded(x, size) ^ jj.folded(y, size)).sum())
        assert apart <= len(np.setxor1d(a, b))


def corpus(seed, words=300):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    passage = " ".join(rng.choice(names) for _ in range(60))
    rows, n = [], 0
    for _ in range(14):
        base = [rng.choice(names) for _ in range(rng.choice([3, 7, 12, 30, 90, 260]))]
        for _ in range(rng.choice([1, 2, 9])):
            text = list(base)
            for _ in range(rng.randrange(1 + len(base) // 40 + rng.randrange(2))):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(2)] = [rng.choice(names)]
            rows.append((n, " ".join(text) + (" " + passage if rng.random() < 0.3 else "")))
            n += 1
    for i in range(30):  # one group of copies that differ in a few words, and chains of it
        text = passage.split()
        text[rng.randrange(len(text))] = f"x{i}"
        rows.append((n + i, " ".join(text)))
    return rows + [(n + 100, "a b c"), (n + 101, "A b  c"), (n + 102, None), (n + 103, ""), (n + 104, " \t")]


def test_against_every_pair(spark):
    rows = corpus(1)
    assert joined(spark, rows) == plain(rows)


def test_frequent_signatures_and_small_blocks(spark, monkeypatch):
    rows = corpus(2, words=60)
    for name, value in {"FREQUENT": 2, "GATHERED": 500, "BLOCK_BYTES": 3000, "SKETCH_BITS": 128}.items():
        monkeypatch.setattr(jj, name, value)
    assert joined(spark, rows, 70) == plain(rows, 70)


def test_unlike_sets_in_one_bucket(spark, monkeypatch):
    """Pairs that no pivot joins are found by the blocks."""
    monkeypatch.setattr(jj, "signatures", lambda found, mixed, bands: iter([(np.array([7], np.uint64), jj._HOME)]))
    rows = corpus(3)
    assert joined(spark, rows) == plain(rows)


def test_odd_rows(spark, odd, none):
    got = {tuple(r) for r in jj.jaccard_join(odd).collect()}
    texts = {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect() if r["doc_id"] is not None}
    assert {r for r in got if r[0] is not None} == {(i, *v) for i, v in plain(texts.items()).items()}
    assert {r for r in got if r[0] is None} == {(None, 1, None), (None, 0, None)}
    assert jj.jaccard_join(odd).count() == odd.count()
    assert jj.jaccard_join(none).collect() == []


def test_ids_of_all_sizes(spark):
    text = " ".join(f"w{i}" for i in range(40))
    ids = [-(1 << 63), -5, 0, (1 << 63) - 1]
    assert joined(spark, [(i, text) for i in ids]) == {i: (36, -(1 << 63)) for i in ids}


def test_repeated_rows_change_nothing(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows + rows[::3], "doc_id bigint, text string").withColumn("sign", F.lit("x"))
    assert {tuple(r) for r in jj.jaccard_join(df).collect()} == {(i, *v) for i, v in plain(rows).items()}
