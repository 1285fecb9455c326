import hashlib
import random
import re
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from fleetwarden.llm import positions, suffix_dedup
from fleetwarden.llm.suffix_dedup import merged, remove_repeats
from fleetwarden.session import CLEANUP_CONF


def plain(texts, length):
    """(n_bytes, n_removed, spans, kept) of each text, by looking at every window."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = [i for i in range(len(t) + 1) if (i < len(t) and gone[i]) != (i > 0 and gone[i - 1])]
        out.append((len(t), sum(gone), list(zip(edges[::2], edges[1::2], strict=True)), bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def check(spark, texts, length):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in remove_repeats(rows, length=length).collect()}
    for i, (size, removed, spans, kept) in enumerate(plain(texts, length)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) == (size, removed, spans, kept), i
        assert r.n_spans == len(spans) and r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def noise(generator, n, alphabet="abcdefghijklmnop é"):
    return "".join(generator.choice(alphabet) for _ in range(n))


@pytest.mark.parametrize("length", [64, 100])
def test_shared_passages(spark, length):
    generator = random.Random(length)
    passages = [noise(generator, n) for n in (length - 3, length, length + 1, 2 * length, 5 * length)]
    texts = []
    for _ in range(60):
        parts = [noise(generator, generator.randrange(0, 3 * length))]
        for _ in range(generator.randrange(4)):
            whole = generator.choice(passages)
            a, b = sorted((generator.randrange(len(whole)), generator.randrange(len(whole))))
            parts += [whole if generator.random() < 0.5 else whole[a:b], noise(generator, generator.randrange(0, length))]
        texts.append("".join(parts))
    check(spark, texts, length)


def test_copies_periods_and_overlaps(spark):
    generator = random.Random(1)
    base = noise(generator, 700)
    texts = [base, base, base[100:], "q" + base[:-1], "ab" * 300, "ab" * 64, "z" * 500, "z" * 64, "z" * 63,
             base[:300] + base[:300], "", None, base[:63], noise(generator, 30)]
    check(spark, texts, 64)


def test_one_text_repeats_itself(spark):
    generator = random.Random(2)
    part = noise(generator, 200)
    check(spark, [part + noise(generator, 50) + part[:150] + noise(generator, 90)], 64)


def test_long_texts_are_cut_into_blocks(spark, monkeypatch):
    generator = random.Random(3)
    part = noise(generator, 400)
    text = noise(generator, 900) + part + noise(generator, 700) + part[50:] + noise(generator, 333)
    flat = np.frombuffer(text.encode(), np.uint8)
    bounds = np.array([0, len(flat)])
    whole = positions.sampled(flat, bounds, 64)
    monkeypatch.setattr(positions, "BLOCK", 256)
    cut = positions.sampled(flat, bounds, 64)

    def by_window(found):
        return {w: (p, h) for p, a, b, h in zip(*(x.tolist() for x in found), strict=True) for w in range(a, b + 1)}

    assert by_window(whole) == by_window(cut) and len(by_window(cut)) == len(flat) - 63


def test_windows_on_both_sides_of_a_block_end(spark, monkeypatch):
    def small_blocks(flat, bounds, length):  # set where it runs: workers import the module anew
        from fleetwarden.llm import positions as own

        before, own.BLOCK = own.BLOCK, 300
        try:
            return own.sampled(flat, bounds, length)
        finally:
            own.BLOCK = before

    monkeypatch.setattr(suffix_dedup, "sampled", small_blocks)
    generator = random.Random(5)
    part = noise(generator, 500)
    texts = [noise(generator, 6000), noise(generator, 700) + part + noise(generator, 900) + part[90:], part[:333]]
    check(spark, [*texts, texts[1], noise(generator, 41) + texts[1]], 64)


def test_a_text_over_two_blocks(spark):
    generator = random.Random(6)
    size, at = (9 << 18) + 77, positions.BLOCK - 300
    text = noise(generator, size, "abcdefghijklmnop ")
    rows = [(1, text), (2, "#" + text[at : at + 700] + "#")]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [tuple(s) for s in got[1].spans] == [(at, at + 700)] and got[1].n_removed == 700
    assert [tuple(s) for s in got[2].spans] == [(1, 701)] and bytes(got[2].kept) == b"##"


def test_equal_windows_have_equal_places():
    generator = random.Random(4)
    shared = noise(generator, 500)
    texts = [(noise(generator, k) + shared + noise(generator, 37)).encode() for k in (0, 11, 300)]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    place, first, last, _ = positions.sampled(flat, bounds, 100)
    rel = {}
    for p, a, b in zip(place.tolist(), first.tolist(), last.tolist(), strict=True):
        for w in range(a, b + 1):
            rel.setdefault(bytes(flat[w : w + 100]), set()).add(p - w)
    assert all(len(v) == 1 for v in rel.values())


def _shuffle_files(spark):
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


def test_finished_rounds_leave_only_what_is_repeated(spark):
    generator = random.Random(7)
    part = noise(generator, 300)
    texts = [noise(generator, 200) + part[i:] + noise(generator, 90) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    files, tables = _shuffle_files(spark), set(shared.rglob("*.parquet"))
    setting = spark.conf.get(CLEANUP_CONF, None)
    lazy = remove_repeats(docs, length=64)
    assert spark.conf.get(CLEANUP_CONF, None) == setting
    left = {re.match("[a-z]+", f.parent.name)[0] for f in set(shared.rglob("*.parquet")) - tables}
    for _ in range(60):  # files are removed beside the driver's work
        if not _shuffle_files(spark) - files:
            break
        time.sleep(0.5)
    assert (left, len(_shuffle_files(spark) - files)) == ({"repeated"}, 0)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in lazy.collect()}
    assert got == {i: (removed, len(spans)) for i, (_, removed, spans, _) in enumerate(plain(texts, 64))}


def test_runs_that_share_a_gram_stay_open(spark):
    generator = random.Random(8)
    part = noise(generator, 150)
    ends = [noise(generator, 80) for _ in range(6)]
    texts = [a + part + b for a in ends[:3] for b in ends[3:]] + [ends[0] + part[:70] + ends[5], part[40:]]
    check(spark, texts, 100)


def test_merging():
    assert merged([5, 0, 20], [6, 2, 20], 4) == [(0, 10), (20, 24)]
    assert merged([0, 4], [0, 4], 4) == [(0, 8)]


def test_odd_tables(odd, none):
    got = remove_repeats(odd, length=64).collect()
    assert len(got) == odd.count()
    twice = [r for r in got if r.doc_id in (1, 2)]
    assert len(twice) == 3 and all(r.n_removed == r.n_bytes > 0 and r.n_spans == 1 for r in twice)
    assert all(r.n_removed == 0 for r in got if r.doc_id in (3, 4, 5, 8))
    assert remove_repeats(none).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(odd, length=40)
