import hashlib
import random

import numpy as np
import pytest

from fleetwarden.llm import fingerprints as fp
from tests.llm.test_near_dedup import plain_set


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in fp.edited_fingerprints(df).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, text) in enumerate(order):
        other, r = order[(k + 1) % len(order)][1], got[i]
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for value, second in ((r.near_edited, edited), (r.near_next, other)):
            a, b = plain_set(text), plain_set(second)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(value - exact) <= (0 if max(len(a), len(b)) < fp.SIZE else 0.2)


def test_next_in_descending_order(spark):
    generator = random.Random(1)
    words = ["aé", "b漢", "cc", "d😀", "ee", "ff", "gg"]
    ids = generator.sample(range(-500, 10_000), 120)
    check(spark, [(i, " ".join(generator.choice(words) for _ in range(generator.randrange(60)))) for i in ids])


def test_few_rows(spark):
    for n in (1, 2, 3):
        check(spark, [(7 * i, f"one two three four five six seven {i}") for i in range(n)])


@pytest.mark.parametrize("partitions", ["1", "3", "61"])
def test_any_number_of_ranges(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        generator = random.Random(5)
        # Most ids are crowded, some are far away.
        ids = [*range(50), *(10**12 + 7**k for k in range(12)), -(10**15)]
        check(spark, [(i, " ".join(generator.choice("ab cd ef gh".split()) for _ in range(generator.randrange(30)))) for i in ids])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_sets_are_estimated(spark):
    generator = random.Random(2)
    check(spark, [(i, " ".join(f"w{generator.randrange(99999)}" for _ in range(3000))) for i in range(6)])


def test_figures():
    generator = np.random.default_rng(3)
    x = np.sort(np.unique(generator.integers(0, 1 << 64, 30_000, dtype=np.uint64)))
    a, b = x[::1][:20_000], x[10_000:]
    a, b = np.sort(generator.permutation(x)[:20_000]), x
    ka, kb = fp.sketch(a), fp.sketch(b)
    assert abs(fp.resemblance(ka, kb) - 2 / 3) < 0.15 and fp.containment(ka, kb) == 1.0
    assert abs(fp.containment(kb, ka) - 2 / 3) < 0.15
    assert abs(fp.distinct(kb) / len(x) - 1) < 0.3 and fp.distinct(fp.sketch(x[:50])) == 50
    none = fp.sketch(x[:0])
    assert fp.resemblance(none, none) == 1.0 and fp.resemblance(none, ka) == 0.0 and fp.containment(none, ka) == 1.0
    assert (fp.from_text(fp.to_text(ka)) == ka).all()


def test_parts_merge(spark):
    texts = [" ".join(f"w{(i * j) % 501}" for j in range(200)) for i in range(1, 13)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(12, None)]
    parts = fp.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))
    merged = fp.merge_fingerprints(parts.selectExpr("doc_id % 2 as k", "fingerprint"), ["k"]).collect()
    own = {r.doc_id: fp.from_text(r.fingerprint) for r in parts.collect()}
    for r in merged:
        union = np.unique(np.concatenate([s for i, s in own.items() if i % 2 == r.k]))[: fp.SIZE]
        assert (fp.from_text(r.fingerprint) == union).all()
    empty = spark.createDataFrame([(1, ""), (1, None)], "k bigint, fingerprint string")
    assert fp.merge_fingerprints(empty, ["k"]).collect()[0].fingerprint == ""


def test_columns_compare(spark):
    parts = fp.fingerprints(spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f h")], "doc_id bigint, text string"))
    both = parts.filter("doc_id = 1").selectExpr("fingerprint as a").crossJoin(parts.filter("doc_id = 2").selectExpr("fingerprint as b"))
    r = both.select(fp.resemblance_of("a", "b"), fp.containment_of("a", "b")).first()
    assert (r.resemblance, r.containment) == (0.5, 2 / 3)


def test_odd_tables(odd, none):
    got = fp.edited_fingerprints(odd).collect()
    assert len(got) == odd.count()
    twins = [r for r in got if r.doc_id in (1, 2)]
    assert len({r.fingerprint for r in twins}) == 1 and sum(r.near_next == 1.0 for r in twins) == 2
    assert fp.edited_fingerprints(none).count() == fp.fingerprints(none).count() == 0
