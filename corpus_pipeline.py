"""From raw documents to encoded training text, in five stages.

Each stage works on all that the one before kept; its result is written as Parquet to the shared
folder and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.llm.common import stored
from fleetwarden.llm.exact_dedup import drop_copies
from fleetwarden.llm.mixing import mix_sources
from fleetwarden.llm.near_dedup import drop_near_copies
from fleetwarden.llm.sentencepiece_nbest import encode_nbest
from fleetwarden.llm.toxicity import drop_toxic

MODEL = "piece_bpe_32k.model"
NBEST = 3
# Rows that a task hands to Python at once. A batch lies in the buffers of the task and of its worker, beside
# whole rows that are read and written; by default it has 10,000 rows.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what a model fitted on the labelled rows rejects."""
    small_batches(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least id stays."""
    small_batches(spark)
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats rows so that a source's share goes with the square root of its size, in random order."""
    return mix_sources(docs, exponent=0.5, seed=17).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, score, ids of the best segmentation; scores of the N best; whether
    the best decodes to the text."""
    small_batches(spark)
    rows = encode_nbest(docs, public_tokenizers.path(MODEL), NBEST)
    best = F.col("paths")[0]
    return rows.select(
        "row.doc_id",
        "row.source",
        F.size(best["ids"]).cast("bigint").alias("n_pieces"),
        best["score"].alias("score"),
        best["ids"].alias("ids"),
        F.col("paths.score").alias("scores"),
        (F.col("decoded") == F.coalesce(F.col("row.text"), F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

# Compression distances and lattice searches are not SQL: tests/llm hold a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
