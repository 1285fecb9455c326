import pickle
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fleetwarden.llm import toxicity as tox

SYLLABLES = "ka lo mi ten sar vo ri qua del fen hu bri".split()
BAD = "grobnik", "zwiffel", "plonkert", "xumbast"


def prose(generator, n, bad=0):
    words = ["".join(generator.choice(SYLLABLES) for _ in range(generator.randrange(1, 4))) for _ in range(n)]
    for _ in range(bad):
        words[generator.randrange(n)] = generator.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    generator = random.Random(1)
    toxic = [prose(generator, 80, 5) for _ in range(200)]
    return tox.train(toxic, [prose(generator, 80) for _ in range(600)], 0.25)


def test_unseen_texts_are_told_apart(model):
    generator = random.Random(2)
    bad = [model.score(prose(generator, generator.randrange(20, 150), 3)) for _ in range(100)]
    good = [model.score(prose(generator, generator.randrange(20, 150))) for _ in range(300)]
    assert sum(s >= tox.REJECT for s in bad) >= 95 and sum(s >= tox.REJECT for s in good) <= 9
    assert all(0 <= s <= 1 for s in bad + good)


def test_late_words_count(model):
    generator = random.Random(3)
    assert model.score(prose(generator, 3000) + " grobnik zwiffel plonkert xumbast" * 20) > model.score(prose(generator, 3080))


def test_a_model_travels(model):
    text = prose(random.Random(4), 60, 2)
    assert pickle.loads(pickle.dumps(model)).score(text) == model.score(text)
    assert len(pickle.dumps(model)) < 100_000


def test_no_words(model):
    assert model.score("") == model.score(" \n\t") == 0.0
    assert 0 <= model.score("x" * 100_000) <= 1


def test_training_is_repeatable_and_needs_both_kinds():
    generator = random.Random(5)
    good, bad = [prose(generator, 30) for _ in range(40)], [prose(generator, 30, 3) for _ in range(20)]
    a, b = tox.train(bad, good, 0.3), tox.train(bad[::-1], good[::-1], 0.3)
    assert (a.toxic, a.weights) == (b.toxic, b.weights)
    assert tox.train([], good, 0.5) is None and tox.train(bad, [], 0.5) is None
    assert tox.train(["x"] * 9, good, 0.5) is None
    assert tox.train(["bad one", "bad two"], ["a", "b", "c", "d"], 0.5) is not None


@pytest.fixture(scope="module")
def tables(spark):
    generator = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        docs.append((i, prose(generator, 60, 4 if bad else 0)))
        if i % 3:
            out = zlib.crc32(str(i).encode()) % 4 == 2
            labels.append((i, 1, int(bad) if not out else 1 - int(bad)))  # lies where labels must not be used
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_labels_are_never_learnt(tables):
    docs, labels = tables
    got = tox.toxicity(docs, labels).collect()
    assert len(got) == 600
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in got) > 570
    without = tox.toxicity(docs, labels.filter(~tox.held_out(F.col("doc_id")))).collect()
    assert sorted(without) == sorted(got)


def learnt(monkeypatch, docs, labels):
    """The (toxic, ordinary) texts that a model is fitted on."""
    monkeypatch.setattr(tox, "train", lambda toxic, ordinary, share: (sorted(toxic), sorted(ordinary)))
    return tox.fit(docs, labels)


def test_a_repeated_id_gives_one_text(tables, monkeypatch):
    docs, labels = tables
    more = docs.sparkSession.range(300).select(F.lit(4).cast("bigint").alias("doc_id"), F.concat(F.lit("~"), "id").alias("text"))
    once = learnt(monkeypatch, docs, labels)
    assert len(once[0]) > 10 and learnt(monkeypatch, docs.unionByName(more), labels) == once


def test_labels_of_other_ids_take_no_room(tables, monkeypatch):
    docs, labels = tables
    other = docs.sparkSession.range(10_000, 30_000).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic")
    )
    monkeypatch.setattr(tox, "MAX_TOXIC", 20)
    monkeypatch.setattr(tox, "MAX_ORDINARY", 50)
    toxic, ordinary = learnt(monkeypatch, docs, labels.unionByName(other))
    assert (len(toxic), len(ordinary)) == (20, 50)


def test_dropping(tables):
    docs, labels = tables
    wide = docs.withColumn("score", F.lit("x")).withColumn("_score", F.lit(1))
    left = tox.drop_toxic(wide, labels)
    assert left.columns == wide.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in tox.toxicity(docs, labels).collect() if not r.predicted}


def test_odd_tables(tables, odd, none):
    labels = tables[1].unionByName(odd.sparkSession.createDataFrame([(None, 1, 1), (3, None, None)], tables[1].schema))
    for use in (labels, labels.limit(0), labels.filter("toxic = 1")):
        got = tox.toxicity(odd, use).collect()
        assert len(got) == odd.count() and all(r.score == 0 for r in got if r.doc_id in (3, 4, 5))
    assert tox.toxicity(none, labels).count() == 0
    assert tox.drop_toxic(odd, labels.limit(0)).count() == odd.count()


def test_held_out_labels_of_the_given_table(sf_dir):
    """Labels that are never learnt, on the largest of the given tables."""
    import pyarrow.parquet as pq

    folder = sf_dir.replace("sf0.001", "sf0.1")
    texts = dict(zip(*(c.to_pylist() for c in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).columns), strict=True))
    marks = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist() if r["toxic"] is not None}
    out = {i for i in marks if zlib.crc32(str(i).encode()) % 4 == 2}
    learnt = {kind: [texts[i] or "" for i, m in marks.items() if m == kind and i not in out] for kind in (0, 1)}
    model = tox.train(learnt[1], learnt[0], len(learnt[1]) / (len(learnt[0]) + len(learnt[1])))
    said = {i: model.score(texts[i] or "") >= tox.REJECT for i in out}
    hits = sum(said[i] and marks[i] == 1 for i in out)
    assert 2 * hits / (sum(said.values()) + sum(marks[i] == 1 for i in out)) > 0.8


def test_words_are_told_by_their_affixes():
    """A made-up beginning that goes with ordinary endings is found, whatever follows it."""
    generator = random.Random(9)
    def bad(n):
        return " ".join([*prose(generator, n).split(), *("grobnik" + generator.choice(SYLLABLES) for _ in range(4))])

    model = tox.train([bad(40) for _ in range(100)], [prose(generator, 40) for _ in range(300)], 0.25)
    assert b" grobnik" in model.toxic
    assert sum(model.score(bad(40)) >= tox.REJECT for _ in range(50)) >= 48
    assert sum(model.score(prose(generator, 44)) >= tox.REJECT for _ in range(100)) <= 5
