from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetwarden.llm.mixing import mix_sources, source_rates


@pytest.fixture
def docs(spark):
    # Source a has three quarters of all rows.
    source = F.when(F.col("id") % 4 != 0, "a").when(F.col("id") % 8 == 0, "b")
    return spark.range(8000).select(F.col("id").alias("doc_id"), source.alias("source"), F.lit("t").alias("copy"))


def test_shares_follow_the_weights(spark, docs):
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 1.0), ("none", 5.0)], "source string, weight double")
    got = Counter(r["source"] for r in mix_sources(docs, weights=weights).select("row.source").collect())
    for source, share in (("a", 2000), ("b", 4000), (None, 2000)):
        assert abs(got[source] - share) < 6 * share**0.5, source


def test_counts_are_poisson(docs):
    got = mix_sources(docs, exponent=1.0).groupBy("row.doc_id").count().collect()
    sizes = Counter(r["count"] for r in got)
    for k, p in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert abs(sizes[k] / 8000 - p) < 0.025
    assert abs(1 - len(got) / 8000 - 0.3679) < 0.025


def test_large_rates_are_split(spark):
    one = spark.createDataFrame([(1, "a")], "doc_id bigint, source string")
    n = mix_sources(one, total=5000).count()
    assert abs(n - 5000) < 6 * 5000**0.5


def test_order_is_random_and_repeatable(docs):
    first = [(r.doc_id, r.copy) for r in mix_sources(docs).select("row.doc_id", "copy").collect()]
    assert first == [(r.doc_id, r.copy) for r in mix_sources(docs.repartition(5)).select("row.doc_id", "copy").collect()]
    keys = [r.shuffle_key for r in mix_sources(docs).collect()]
    assert keys == sorted(keys)
    other = mix_sources(docs, seed=18).select("row.doc_id", "copy").collect()
    assert first != [(r.doc_id, r.copy) for r in other]


def test_rates(docs):
    rates = {r["source"]: r.rate for r in source_rates(docs, exponent=0.0).collect()}
    assert rates["a"] == pytest.approx(8000 / 3 / 6000)


def test_odd_tables(odd, none):
    mixed = mix_sources(odd, total=200)
    assert mixed.select("row.*").columns == odd.columns
    ids = Counter(r.doc_id for r in mixed.select("row.doc_id").collect())
    assert None in ids and ids[2] % 2 == 0  # rows that share an id are drawn alike
    assert mix_sources(none).count() == 0
