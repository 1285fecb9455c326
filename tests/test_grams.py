"""Grams against plain substring search."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetwarden.operators import grams as gr
from fleetwarden.operators import health as hl
from tests.test_skew import final_plan


def words(n, seed, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é\n漢") for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("length", [n for n in gr.GRAMS if n])
def test_pieces_are_the_grams_of_each_text(length, monkeypatch):
    monkeypatch.setattr(gr, "BLOCK", 7)
    texts = [w for w in words(60, length, 40)]
    owner, key = gr._pieces(pa.array(texts).slice(3), length, None)
    got = {}
    for o, k in zip(owner.tolist(), key.tolist(), strict=True):
        got.setdefault(o, set()).add(k)
    seen = {}
    for i, text in enumerate(texts[3:]):
        raw = text.encode()
        want = {raw[j : j + length] for j in range(len(raw) - length + 1)}
        assert len(got.get(i, ())) == len(want)
        seen.setdefault(frozenset(want), got.get(i, set()))
        assert seen[frozenset(want)] == got.get(i, set())


def test_exclusion_equals_plain_search(spark):
    lines, patterns = words(300, 1, 60) + [None, ""], [w for w in words(80, 2, 24) if w] + [None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    table = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    want = [i for i, s in enumerate(lines) if s is None or not any(p is not None and p in s for p in patterns)]
    assert sorted(r["id"] for r in hl.log_exclude_table(df, table).collect()) == want


def test_lines_are_never_built(spark, sf_dir):
    """The semi join can build the index only, and of the lines only grams with a bit go on."""
    plan = final_plan(entry.queries()["log_exclude_table"](spark, sf_dir))
    assert "LeftSemi" in plan and "BuildLeft" not in plan and "NestedLoop" not in plan
    texts = spark.range(4000).select(F.concat(F.lit("line "), F.sha2(F.col("id").cast("string"), 256)).alias("t"))
    index = gr.gram_index(spark.createDataFrame([("no such line at all",), ("nor this one",)], "p string"), "p")
    assert gr.gram_hits(texts, "t", index).count() < 50  # of 4,000 x 69 x 2 grams


def test_index_takes_the_rarest_gram(spark):
    strings = [f"the common beginning {i:04d}" for i in range(50)] + ["", "x", "the common"]
    index = gr.gram_index(spark.createDataFrame([(s,) for s in strings] * 2, "p string"), "p")
    rows = index.collect()
    assert len(rows) == len(strings)
    assert max(np.unique([r["_gram"] for r in rows], return_counts=True)[1]) <= 10


def test_empty_tables(spark):
    none = spark.createDataFrame([], "pattern string")
    lines = spark.createDataFrame([("a",), (None,)], "line string")
    assert hl.log_exclude_table(lines, none).count() == 2
    assert hl.log_exclude_table(lines.limit(0), spark.createDataFrame([("a",)], "pattern string")).count() == 0
