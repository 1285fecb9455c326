"""Exact dedup by skew-safe combining.

Copies are combined three times: within each map task, within each (digest, salt), and within each
digest. All three group by the full text beside its digest, so every stage compares whole contents
and the digest only decides where rows meet. A text that a third of all rows share reaches the
salted stage as one row per map task, spread over the salts, and the last stage as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import packed, stored, text_of, texts
from fleetwarden.operators.lookup import look_up

SALTS = 16


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combine_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size.

    NULL texts count as empty; NULL ids count in group_size and are kept only where a text has no
    other id (keep_id NULL). No rows give no rows.
    """
    rows = texts(docs, id_col, text_col).withColumn("digest", content_digest(F.col("text")))
    # The partial step of this aggregate is the local dedup: it runs before the shuffle.
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # One exchange by digest serves this stage and the check that follows it.
    return (
        salted.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per digest: digest, keep_id, group_size.

    Two different texts of one digest would end the job with an error, never merge.
    """
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("bigint"))
    return (
        combine_copies(docs, id_col, text_col, salts)
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), one.alias("_fault"))
        .filter(F.col("_fault").isNull())
        .drop("_fault")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Texts are equal when identical without any
    change; NULL is the empty text. Of rows that share id and text, one stays. NULL ids: see
    :func:`combine_copies`. Other columns are not read.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", content_digest(F.col("text")).alias("digest"))
    # The place of each row, written so that it stays the same. Of rows that repeat one id and text the first
    # stays: its place is a minimum, taken in each task before anything is shuffled.
    rows = stored(rows.withColumn("_place", F.monotonically_increasing_id()), "places")
    rows = rows.withColumn("_pair", F.struct("doc_id", "digest"))
    firsts = rows.groupBy("_pair").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_times"))
    rows = look_up(rows, firsts.filter("_times > 1").drop("_times"), ["_pair"])
    first = F.col("_first").isNull() | (F.col("_first") == F.col("_place"))
    return look_up(rows, winners(docs, id_col, text_col, salts), ["digest"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows that :func:`exact_dedup` keeps, with all their columns.

    Of rows that share id and text, one stays, whichever.
    """
    rows = packed(docs).select(
        "_row",
        F.col(f"_row.{id_col}").alias("_id"),
        content_digest(text_of(f"_row.{text_col}")).alias("digest"),
    )
    often = rows.groupBy("_id", "digest").agg(F.count(F.lit(1)).alias("_often")).filter("_often > 1")
    often = stored(often.select(F.col("_id").alias("_twice"), F.col("digest").alias("_of"), "_often"), "repeated-rows")
    best = winners(docs, id_col, text_col, salts)
    if often.isEmpty():
        # No row is repeated, mostly: one branch is enough, and the texts move once less.
        kept = look_up(rows, best, ["digest"])
        return kept.filter(F.col("_id").eqNullSafe(F.col("keep_id"))).select("_row.*")
    # Which winners are repeated is settled on the narrow table, before the texts move.
    same = F.col("keep_id").eqNullSafe(F.col("_twice")) & (F.col("digest") == F.col("_of"))
    best = best.join(often, same, "left").select("digest", "keep_id", "_often")
    kept = look_up(rows, best, ["digest"]).filter(F.col("_id").eqNullSafe(F.col("keep_id")))
    single = kept.filter("_often is null")
    many = kept.filter("_often > 1").dropDuplicates(["_id", "digest"])
    return single.unionByName(many).select("_row.*")
