"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on the parts of words that are far more frequent in toxic
texts than in ordinary ones, one of the same size on ordinary texts, both above the same base of common
ordinary material. A text is cut into windows of one word; a window's distance is its compressed length
with the ordinary dictionary less that with the toxic one. Calibrated thresholds on these distances give
the score.

Each window is compressed between two fixed strings that both dictionaries hold: a block needs some
length before the compressor looks for matches, and it looks for none in its last bytes.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.llm.common import packed, text_of, texts

MAX_TOXIC, MAX_ORDINARY = 2_000, 8_000  # labelled texts that a model is fitted on, at most
MAX_BYTES = 32 << 20  # and their total size
AFFIX = range(4, 11)  # bytes of the beginnings and ends of words, the space beside them included
# An affix is toxic if so many toxic texts have it, this share of them at least, and ODDS times as large a
# share of the words of toxic texts as of ordinary ones.
LEAST, SHARE, ODDS = 3, 0.01, 16
BASE, OWN = 32 << 10, 8 << 10  # bytes of the common and, at most, of each separate part
WINDOW = 64  # bytes of a word compressed at once: longer words make several windows
STEPS = (2, 3, 4, 5, 6)  # thresholds on the distance, in bytes
CACHE_SIZE = 1 << 18  # windows whose distance a worker remembers
REJECT = 0.3  # texts from this score on are predicted toxic

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def windows(text: str) -> list[bytes]:
    found = _WORD.findall(text.encode("utf-8", "replace").lower())
    if any(len(w) > WINDOW for w in found):
        found = [w[i : i + WINDOW] for w in found for i in range(0, len(w), WINDOW)]
    return found


def _some(texts_: Sequence[str], longer: int, most: int = 300_000) -> list[bytes]:
    """The windows of more than ``longer`` bytes of the first texts, about ``most`` of them at most."""
    found: list[bytes] = []
    for t in texts_:
        if len(found) >= most:
            break
        found.extend(w for w in windows(t) if len(w) > longer)
    return found


def _spread(texts_: Sequence[str]) -> Counter[bytes]:
    """How many of the texts hold each window."""
    found: Counter[bytes] = Counter()
    for t in texts_:
        found.update(set(windows(t)))
    return found


def _affixes(word: bytes) -> set[bytes]:
    spaced = b" " + word + b" "
    ends = [n for n in AFFIX if n <= len(spaced)]
    return {spaced[:n] for n in ends} | {spaced[-n:] for n in ends}


def _stretches(word: bytes, toxic: set[bytes]) -> list[bytes]:
    """The parts of a word that toxic affixes cover: its beginning, its end, or all of it."""
    spaced = b" " + word + b" "
    head = max((n for n in AFFIX if spaced[:n] in toxic), default=0)
    tail = max((n for n in AFFIX if spaced[-n:] in toxic), default=0)
    if head + tail >= len(spaced):
        return [spaced]
    return [part for part in (spaced[:head], spaced[len(spaced) - tail :]) if part]


def _own(toxic: Sequence[str], ordinary: Counter[bytes], n_ordinary: int) -> bytes:
    """Dictionary content for toxic texts, the most frequent parts last; ``ordinary`` counts affixes."""
    words = _spread(toxic)
    total = sum(words.values())
    counts: Counter[bytes] = Counter()
    for w, c in words.items():
        for affix in _affixes(w):
            counts[affix] += c
    least, odds = max(LEAST, SHARE * len(toxic)), math.log(ODDS)
    marks = {
        g for g, c in counts.items()
        if c >= least and math.log((c + 0.5) / total) - math.log((ordinary[g] + 0.5) / n_ordinary) >= odds
    }
    parts: Counter[bytes] = Counter()
    for w, c in words.items():
        for part in _stretches(w, marks):
            parts[part] += c
    ranked = sorted(parts, key=lambda p: (-parts[p], p))
    return b"".join(reversed(ranked))[-OWN:]


def _train(samples: Sequence[bytes], size: int, segment: int) -> bytes:
    """Dictionary content of ``size`` bytes at most; too few samples are taken as they are."""
    usable = [s for s in samples if len(s) > 5]
    try:
        return zstandard.train_dictionary(size, usable, k=segment, d=6, level=3).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(s for s, _ in Counter(samples).most_common())[:size]


@dataclass
class ToxicModel:
    """Dictionary parts and calibration; small enough to go to every task."""

    base: bytes
    toxic: bytes
    ordinary: bytes
    weights: list[float] = field(default_factory=list)
    center: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._ready()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def _ready(self) -> None:
        parameters = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=15, search_log=6, min_match=4, target_length=32,
            strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self._compress = []
        for own in (self.ordinary, self.toxic):
            content = zstandard.ZstdCompressionDict(self.base + own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=parameters)
            compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=content)
            self._compress.append(compressor.compress)
        third = len(self.base) // 8
        self._before, self._after = self.base[third : third + 200] + b" ", b" " + self.base[2 * third : 2 * third + 100]
        self._cache: dict[bytes, int] = {}

    def distance(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves over the ordinary one."""
        found = self._cache.get(window)
        if found is None:
            framed = self._before + window + self._after
            ordinary, toxic = self._compress
            found = len(ordinary(framed)) - len(toxic(framed))
            if len(self._cache) >= CACHE_SIZE:
                self._cache.clear()
            self._cache[window] = found
        return found

    def features(self, text: str) -> list[float]:
        """Mean, largest distances, and how many windows, and which share, reach each threshold."""
        seen = Counter(map(self.distance, windows(text)))
        n = sum(seen.values())
        if not n:
            return [0.0] * (4 + 2 * len(STEPS))
        top = sorted(seen, reverse=True)
        best = [d for d in top for _ in range(min(seen[d], 3))][:3]
        reach = [sum(c for d, c in seen.items() if d >= step) for step in STEPS]
        return [
            sum(d * c for d, c in seen.items()) / n, top[0], sum(best) / len(best), float(np.log1p(n)),
            *(min(r, 10) for r in reach), *(r / n for r in reach),
        ]

    def score(self, text: str) -> float:
        """0 to 1, higher for toxic; 0 without words or without a calibration."""
        if not self.weights or not _WORD.search(text.encode("utf-8", "replace")):
            return 0.0
        x = (np.array(self.features(text)) - self.center) / self.scale
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ np.array(self.weights[1:]), -40, 40))))

    def calibrate(self, toxic: Sequence[str], ordinary: Sequence[str], share: float, cut: float) -> None:
        """Logistic fit on texts that the dictionaries were not trained on.

        ``share`` is the toxic share among the labels; the scores are moved so that ``cut`` is the
        score that separates best (largest F1 at that share).
        """
        y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
        raw = np.array([self.features(t) for t in [*toxic, *ordinary]])
        center, scale = raw.mean(0), raw.std(0) + 1e-9
        x = np.c_[np.ones(len(y)), (raw - center) / scale]
        weight = np.where(y == 1, share / max(len(toxic), 1), (1 - share) / max(len(ordinary), 1)) * len(y)
        w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
        ridge[0] = 1e-6
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            slope = x.T @ (weight * (y - p)) - ridge * w
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            w = w + np.clip(np.linalg.solve(bend, slope), -5, 5)
        z = x @ w
        steps = np.unique(z)
        # Between two scores, a cut nearer to the lower one: ordinary texts differ less in score than
        # toxic texts, which may hold many toxic words or few.
        cuts = (3 * steps[:-1] + steps[1:]) / 4 if len(steps) > 1 else steps
        hits = [(weight[(z > t) & (y == 1)].sum(), weight[z > t].sum()) for t in cuts]
        f1 = np.array([2 * a / (b + weight[y == 1].sum()) for a, b in hits])
        best = cuts[f1 >= f1.max() - 1e-12]
        w[0] += np.log(cut / (1 - cut)) - (3 * best.min() + best.max()) / 4
        self.weights, self.center, self.scale = w.tolist(), center.tolist(), scale.tolist()


def train(toxic: Sequence[str], ordinary: Sequence[str], share: float, cut: float = REJECT, seed: int = 1) -> ToxicModel | None:
    """A model from labelled texts; None unless there are two of either kind at least.

    Half of the toxic and three quarters of the ordinary texts train the dictionaries, the rest the
    calibration. The order of the texts does not matter.
    """
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    if len(toxic) < 2 or len(ordinary) < 4:
        return None
    shuffle = random.Random(seed)
    shuffle.shuffle(toxic)
    shuffle.shuffle(ordinary)
    half, quarter = len(toxic) // 2, len(ordinary) // 4
    reference, contrast, rest = ordinary[: 2 * quarter], ordinary[2 * quarter : 3 * quarter], ordinary[3 * quarter :]
    base = _train([b" " + w for w in _some(reference, 2)], BASE, 48)
    known = {g for w in _spread(toxic[:half]) for g in _affixes(w)}
    affixes: Counter[bytes] = Counter()
    common = _spread(reference + contrast)
    for w, c in common.items():
        for g in _affixes(w) & known:
            affixes[g] += c
    total = sum(common.values())
    del known, common
    more = [w + b" " for w in _some(contrast, 4)]
    other = _train(more, OWN, 32) + b"".join(more[: OWN // 5])

    own = _own(toxic[:half], affixes, total)
    model = ToxicModel(base, own, other[: len(own)])
    model.calibrate(toxic[half:], rest, share, cut)
    return model


def held_out(id_: Column) -> Column:
    """Rows whose labels must not be learnt."""
    return F.crc32(id_.cast("string")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> ToxicModel | None:
    """A model from the labelled rows that are not held out.

    Fitted on the driver, on MAX_TOXIC and MAX_ORDINARY rows at most, chosen by a hash of the id, and
    MAX_BYTES of text at most; NULL labels and those of ids that ``docs`` lacks are left out. Of an id's
    texts the least counts. None without labels of both kinds.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    known = known.filter("_toxic is not null and _id is not null").filter(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    rows = texts(docs, id_col, text_col)
    known = known.join(rows.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_semi")
    counts = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    mix = F.xxhash64("_id")
    ids = [
        (r["_id"], kind)
        for kind, most in ((1, MAX_TOXIC), (0, MAX_ORDINARY))
        for r in known.filter(F.col("_toxic") == kind).orderBy(mix, "_id").limit(most).collect()
    ]

    def chosen(keys: list[tuple[int, int]]) -> DataFrame:
        # Bounded by the parameters above, whatever the size of the tables.
        small = spark.createDataFrame(keys, "_id bigint, _toxic int")
        found = rows.join(F.broadcast(small), F.col("doc_id") == F.col("_id"))
        return found.groupBy("_id", "_toxic").agg(F.min("text").alias("text"))

    sizes = {r["_id"]: r["n"] for r in chosen(ids).select("_id", F.octet_length("text").alias("n")).collect()}
    kept, room = [], {1: MAX_BYTES // 3, 0: MAX_BYTES - MAX_BYTES // 3}
    for id_, kind in ids:
        if id_ in sizes and sizes[id_] <= room[kind]:
            room[kind] -= sizes[id_]
            kept.append((id_, kind))
    if not kept:
        return None
    found = [(r["_toxic"], r["text"]) for r in chosen(kept).select("_toxic", "text").collect()]
    share = counts[1] / (counts[0] + counts[1])
    return train([t for k, t in found if k], [t for k, t in found if not k], share)


def with_score(rows: DataFrame, text: Column, model: ToxicModel | None, name: str = "score") -> DataFrame:
    """``rows`` with the score of a text column; all 0 without a model."""
    if model is None:
        return rows.withColumn(name, F.lit(0.0))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(t.as_py() or "") for t in column], pa.float64())

    return rows.withColumn(name, score(text))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = REJECT
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (1 if score >= ``cut``).

    The score depends on the text alone. NULL, empty and blank texts score 0, and so does every text
    if ``labels`` lacks one of the two kinds. Texts of any length are read whole. Equal texts score
    alike; NULL ids come out with held_out false.
    """
    scored = with_score(texts(docs, id_col, text_col), F.col("text"), fit(docs, labels, id_col, text_col))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = REJECT
) -> DataFrame:
    """The rows that :func:`toxicity` does not predict to be toxic, with all their columns."""
    scored = with_score(packed(docs), text_of(f"_row.{text_col}"), fit(docs, labels, id_col, text_col), "_score")
    return scored.filter(F.col("_score") < cut).select("_row.*")
