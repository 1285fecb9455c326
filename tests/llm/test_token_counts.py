import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetwarden.llm.token_counts import checked, counting, summary, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
SOME = "abXYZ'sStTm019 \n\t\x0b\x1c\x00\x85\xa0áÉßǅſİ́KΣ–’€™.,!<|>{}½²ª漢ก"


@pytest.fixture(scope="module")
def own():
    return checked(PATH)


def library(text):
    return len(counting(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids)


@given(st.one_of(st.text(alphabet=SOME, max_size=20), st.text(max_size=20)), st.sampled_from(["", "<|endoftext|>", "<|StartOfText|>"]))
@settings(max_examples=1500, deadline=None)
def test_counts_are_the_librarys(own, text, special):
    assert own.count(text + special + text, {}) == library(text + special + text)


def test_every_settled_character(own):
    for c in map(chr, [*range(0x250), *range(0x1E00, 0x1EA0), *range(0x2000, 0x2070), 0x20AC, 0x2122]):
        for text in (f"a{c}b", c + c, f"1{c}!", f" {c}'s"):
            assert own.count(text, {}) == library(text), (hex(ord(c)), text)


def test_table_and_cache_change_nothing(own, monkeypatch):
    monkeypatch.setattr("fleetwarden.llm.token_counts.CACHE_SIZE", 2)
    text = "don't WE'LL stop now, now, unbelievable unbelievable words"
    assert own.count(text, {"now": own.length("now"), ",": 1}) == library(text)


def test_summary_is_bounded():
    found = summary(iter([f"a b w{i}" for i in range(1000)]), str.split, 4)
    assert found[:2] == [("a", 1000), ("b", 1000)] and len(found) == 4


def test_odd_tables(odd, none):
    got = token_counts(odd, PATH, limit=100).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.collect()]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len(t.encode()), library(t), library(t) > 100) for i, t in texts
    )
    assert token_counts(none, PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        checked(public_tokenizers.path("byte_bpe_50k.json"))
