"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a hash table from frequent pre-tokens to their number of tokens, broadcast; tier two is
a cache in each Python worker, filled by encoding what tier one misses. A pre-token is thus merged
once for each worker and not once for each occurrence, and no pre-token crosses a shuffle: what does
is one summary of bounded size for each task, from which the table is chosen.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import texts

TABLE_SIZE = 1 << 14  # pre-tokens in the broadcast table: under 1 MB
SUMMARY_SIZE = 1 << 12  # pre-tokens a task reports
CACHE_SIZE = 1 << 18  # pre-tokens in each of a worker's two generations of remembered ones: 80 MB in all

# Characters whose case and class are the same in every version of Unicode that a library may use,
# and which composition (NFC) leaves alone. A text with any other character is encoded by the library
# as a whole.
_UNSETTLED = regex.compile(r"[^\x00-\x7f\xa0-ɏḀ-ẟ‐-‧‰-›€™]")
# The split of the vocabulary file, with its white space spelt out.
_PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}"
    r"|[^\p{L}\p{N}\t-\r \x85\xa0  -     　]+"
)


class Counting:
    """Lengths of pre-tokens and texts under one vocabulary file, with this worker's cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special)), regex.I) if special else None
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def length(self, pretoken: str) -> int:
        """Tier two: the worker's cache; when one generation is full, the one before is dropped."""
        found = self.new.get(pretoken)
        if found is None:
            found = self.old.get(pretoken)
            if found is None:
                found = self.whole(pretoken)
            if len(self.new) >= CACHE_SIZE:
                self.old, self.new = self.new, {}
            self.new[pretoken] = found
        return found

    def split(self, text: str) -> list[str] | None:
        """The pre-tokens; None where only the library may split the text."""
        if not text.isascii() and _UNSETTLED.search(text):
            return None
        if self.special and self.special.search(text):
            return None
        return _PRETOKEN.findall(text.lower())

    def count(self, text: str, table: dict[str, int]) -> int:
        pretokens = self.split(text)
        if pretokens is None:
            return self.whole(text)
        known = list(map(table.get, pretokens))
        total = sum(filter(None, known))
        for pretoken, n in zip(pretokens, known, strict=True):
            if n is None:
                total += self.length(pretoken)
        return total


@lru_cache(maxsize=4)
def counting(path: str) -> Counting:
    return Counting(path)


def checked(path: str) -> Counting:
    """The vocabulary of ``path``, if its normalisation and split are those this module knows."""
    import json

    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    kinds = [n["type"] for n in (given["normalizer"] or {}).get("normalizers", [])]
    splits = [p["type"] for p in (given["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if kinds != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
        raise ValueError(f"{path} normalises or splits texts in another way")
    return counting(path)


def summary(texts_: Iterator[str], split: Callable[[str], list[str] | None], size: int) -> list[tuple[str, int]]:
    """The most frequent pre-tokens in bounded memory: all texts are counted, rare ones are forgotten."""
    seen: Counter[str] = Counter()
    for text in texts_:
        seen.update(split(text) or ())
        if len(seen) > 16 * size:
            seen = Counter(dict(seen.most_common(4 * size)))
    return seen.most_common(size)


def frequent_pretokens(rows: DataFrame, path: str, size: int = TABLE_SIZE, per_task: int = SUMMARY_SIZE) -> list[str]:
    """The most frequent pre-tokens of all texts, ``size`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = summary((t.as_py() for b in batches for t in b.column(0)), counting(path).split, per_task)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
            ["pretoken", "n"],
        )

    parts = rows.select("text").mapInArrow(run, "pretoken string, n bigint")
    best = parts.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(size)
    return [r["pretoken"] for r in best.collect()]


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    ``path`` is a vocabulary file of the ``tokenizers`` library that every worker can read. Counts are
    the library's for the whole text, without added begin or end, special strings inside texts as it
    handles them by default, without truncation or padding. NULL and empty texts have no tokens;
    repeated rows and NULL ids come out as they are; other columns are not read. The choice of
    frequent pre-tokens decides on speed only.
    """
    rows = texts(docs, id_col, text_col)
    own = checked(path)
    table = {p: own.length(p) for p in frequent_pretokens(rows, path)}
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, counter = shared.value, counting(path)
        for batch in batches:
            counts = [counter.count(t.as_py(), lengths) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = rows.select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
