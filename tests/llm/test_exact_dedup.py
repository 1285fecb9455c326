import hashlib
from collections import Counter

from fleetwarden.llm.exact_dedup import drop_copies, exact_dedup


def plain(rows):
    """(doc_id, keep_id, group_size, sha) of each row, by a dictionary of texts."""
    groups: dict[str, list] = {}
    for id_, text in rows:
        groups.setdefault(text or "", []).append(id_)
    out = Counter()
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        for i in ids:
            out[(i, max(named, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def check(spark, rows):
    got = exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), salts=3).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plain(rows)
    # One row of each text stays: with the id that is kept, or one of those without id.
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == {r.text_sha256 for r in got} and set(kept.values()) <= {1}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_groups(spark):
    check(spark, [(i, f"text {i % 7}" if i % 3 else "hot") for i in range(300)])


def test_one_row_repeated_very_often(spark):
    check(spark, [(7, "hot")] * 200 + [(i, f"text {i}") for i in range(20)] + [(None, "hot")] * 50)


def test_ties_and_nulls(spark):
    check(spark, [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "a"), (None, "only"), (4, "A"), (5, "a "), (6, " a")])


def test_odd_tables(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = exact_dedup(odd)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()) == plain(rows)
    assert exact_dedup(none).count() == 0


def test_dropping_keeps_columns(odd, none):
    left = drop_copies(odd)
    assert left.columns == odd.columns
    got = left.collect()
    assert Counter((r.text or "") for r in got) == Counter(set((r.text or "") for r in odd.collect()))
    assert next(r.doc_id for r in got if r.text and r.text.startswith("The quick")) == 2
    assert drop_copies(none).count() == 0
    alone = odd.dropDuplicates(["doc_id", "text"])
    assert sorted(map(str, (r.doc_id for r in drop_copies(alone).collect()))) == sorted(map(str, (r.doc_id for r in got)))
