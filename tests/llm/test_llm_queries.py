"""The registered queries and the pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fleetwarden.llm.queries import ORACLES, QUERIES
from tests.compare import compare, duck


def test_every_operator_has_a_query():
    names = {n.split("_")[0] for n in QUERIES} - {"pipeline"}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    _, found = compare(spark, duck(sf_dir), QUERIES[name], ORACLES[name], sf_dir)
    assert not found


OWN = {"pipeline", "op12_conversation_repair", "op13_whitening"}  # their rows are tested elsewhere


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - OWN))
def test_one_row_per_row(spark, sf_dir, name):
    given = "pages" if name.startswith("op9") else "documents"
    ids = "page_id" if name.startswith("op9") else "doc_id"
    got = [r[0] for r in QUERIES[name](spark, sf_dir).select(ids).collect()]
    assert sorted(got) == sorted(r[0] for r in spark.read.parquet(f"{sf_dir}/{given}.parquet").select(ids).collect())


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against a plain version that works on the rows the stage before left."""
    from fleetwarden.llm import toxicity
    from fleetwarden.llm.sentencepiece_nbest import pieces
    from tests.llm.test_near_dedup import plain as plain_near

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "mixing", "sentencepiece"]

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    clean = stages["toxicity"](spark, docs, sf_dir)
    model = toxicity.fit(docs, labels)
    assert rows(clean) == [r for r in rows(docs) if model is None or model.score(r[1] or "") < toxicity.REJECT]

    single = stages["exact dedup"](spark, clean, sf_dir)
    largest = {r[1] or "": r for r in rows(clean)}  # the last of each text has the largest id
    assert rows(single) == sorted(largest.values())

    distinct = stages["near dedup"](spark, single, sf_dir)
    component = plain_near([(r[0], r[1]) for r in rows(single)])
    assert rows(distinct) == [r for r in rows(single) if component[r[0]][1] == r[0]]

    mixed = stages["mixing"](spark, distinct, sf_dir)
    assert mixed.columns == distinct.columns == docs.columns
    assert set(rows(mixed)) <= set(rows(distinct)) and abs(mixed.count() - distinct.count()) < 6 * distinct.count() ** 0.5

    encoded = stages["sentencepiece"](spark, mixed, sf_dir).collect()
    own = pieces(corpus_pipeline_path(), 1).processor
    texts = {r[0]: r[1] or "" for r in rows(distinct)}
    assert len(encoded) == mixed.count() and all(own.decode(r.ids) == texts[r.doc_id] and r.round_trip for r in encoded)

    end = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_pieces, tuple(r.ids)) for r in end) == sorted((r.doc_id, r.n_pieces, tuple(r.ids)) for r in encoded)


def corpus_pipeline_path():
    import public_tokenizers

    return public_tokenizers.path(corpus_pipeline.MODEL)


def test_pipeline_hands_few_rows_to_python_at_once(spark, sf_dir):
    """Batches of 10,000 rows beside whole rows took more memory than an executor has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for stage in ("toxicity", "near dedup", "sentencepiece"):
        spark.conf.unset(name)
        dict(corpus_pipeline.STAGES)[stage](spark, docs, sf_dir)
        assert int(spark.conf.get(name)) == corpus_pipeline.BATCH_ROWS <= 1_000
    spark.conf.unset(name)
