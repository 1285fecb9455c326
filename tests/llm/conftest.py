from __future__ import annotations

import pytest

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use themselves.
CLASHING = ("digest", "keep_id", "kept", "_row", "row", "copy", "score", "_score", "t1", "salt", "bucket", "part")


def clashing(df):
    """The table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture
def odd(spark):
    """NULLs in every column, empty and blank texts, a very long one, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(40_000))
    prose = "The quick brown fox jumps over the lazy dog while seven wizards watch from afar " * 8
    rows = [
        (1, prose, "en", "a", 1),
        (2, prose, "en", "b", 1),
        (2, prose, "en", "b", 1),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, " \t\n", "en", "a", 3),
        (6, long, "en", "a", None),
        (7, long + " tail", None, "a", None),
        (None, "no id here", "en", None, None),
        (None, None, None, None, None),
        (8, "Größe 漢字 ΑΣ <|endoftext|> ça", "de", "b", 5),
    ]
    return clashing(spark.createDataFrame(rows, ODD))


@pytest.fixture
def none(odd):
    return odd.limit(0)
