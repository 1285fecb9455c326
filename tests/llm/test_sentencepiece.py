import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetwarden.llm.sentencepiece_nbest import Pieces, decode_ids, encode_nbest, nbest_digests

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH, 3)


def every(pieces, text):
    """All segmentations (score, ids) of a normalised text."""
    if not text:
        return [(0.0, ())]
    out = []
    for end in range(1, len(text) + 1):
        arc = pieces.arcs.get(text[:end])
        if arc is None and end > 1:
            continue
        score, ids = (arc[0], (arc[1],)) if arc else (pieces.unknown, pieces._fallback(text[0]))
        out += [(score + s, ids + i) for s, i in every(pieces, text[end:])]
    return out


def ids_of(path):
    return tuple(np.frombuffer(path.ids, "<i4").tolist())


@given(st.text(alphabet="the anoion .,'漢é\n\tx1", max_size=9))
@settings(max_examples=400, deadline=None)
def test_best_of_all_segmentations(pieces, text):
    every_ = every(pieces, pieces.processor.normalize(text) if text else "")
    scores = dict((i, s) for s, i in every_)
    found = pieces.encode(text)
    assert [p.score for p in found] == sorted(scores.values(), reverse=True)[:3]
    assert len({ids_of(p) for p in found}) == len(found)
    assert all(scores[ids_of(p)] == p.score for p in found)


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_round_trip(pieces, text):
    best = pieces.encode(text)[0]
    if "▁" not in text and "\0" not in text:
        assert pieces.decode(best.ids) == text
    assert pieces.processor.decode(list(ids_of(best))) == pieces.decode(best.ids)


def test_repeated_words_change_one_by_one(pieces):
    generator = random.Random(1)
    for _ in range(20):
        text = " ".join(generator.choice(["an", "on", "io"]) for _ in range(4))
        scores = sorted((s for s, _ in every(pieces, pieces.processor.normalize(text))), reverse=True)[:3]
        assert [p.score for p in pieces.encode(text)] == scores


def test_remembering_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr("fleetwarden.llm.sentencepiece_nbest.CACHE_SIZE", 3)
    small = Pieces(PATH, 3)
    text = "some words that come again, some words that come again and again " * 3
    assert small.encode(text) == pieces.encode(text) == small.encode(text)


def test_long_units(pieces):
    for text in ("x" * 50_000, "漢" * 20_000, "1" * 50_000):
        assert pieces.decode(pieces.encode(text)[0].ids) == text


def test_odd_tables(odd, none):
    got = encode_nbest(odd, PATH, 2)
    assert got.select("row.*").columns == odd.columns
    rows = got.select("row.text", "paths", "decoded").collect()
    assert len(rows) == odd.count() and all(r.decoded == (r.text or "") for r in rows)
    assert all(r.paths[0].score == 0 and r.paths[0].ids == [] for r in rows if not r.text)
    best = got.select("row.text", got.paths[0]["ids"].alias("ids"))
    assert all(r.decoded == (r.text or "") for r in decode_ids(best, PATH).collect())
    assert all(r.round_trip for r in nbest_digests(odd, PATH).collect())
    assert encode_nbest(none, PATH).count() == nbest_digests(none, PATH).count() == 0


def test_units_are_the_same_by_both_patterns(pieces):
    """Texts without characters above U+FFFF are cut by the standard library's pattern."""
    every_ = "".join(chr(c) for c in (*range(0xD800), *range(0xE000, 0x10000)))
    words = "".join(f"{c}a b{c}▁" for c in every_)
    assert pieces.short_unit.findall(words) == pieces.unit.findall(words) == pieces.units(words)
    high = "".join(f"a{chr(c)}b▁" for c in range(0x10000, 0x20000))
    assert pieces.units(high) == pieces.unit.findall(high) != pieces.short_unit.findall(high)


def test_units_remembered_beside_rows_are_few():
    """An executor of the pipeline holds two workers beside the rows: neither may remember much."""
    from fleetwarden.llm import sentencepiece_nbest as own

    assert own.CACHE_SIZE // own.BESIDE_ROWS <= 1 << 15
