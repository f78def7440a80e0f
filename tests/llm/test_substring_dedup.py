import pytest

from freshet.llm import queries
from freshet.llm.common import pack_places, unpack_places
from freshet.llm.substring_dedup import digests, remove_repeats
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def dedup(docs, width=20):
    return {i: found[:3] for i, found in brute.substring_dedup(docs, width).items()}


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    got = as_dict(queries.op2_substring_dedup(spark, FOLDER))
    assert got == dedup(brute.corpus(FOLDER))


def test_edge_texts(spark):
    docs = brute.edge_docs(spark)
    assert as_dict(digests(docs)) == dedup([(r[0], r[1]) for r in brute.edge_rows()])


def test_null_ids_come_first_and_repeated_rows_agree(spark):
    text = " ".join(map(str, range(30)))
    rows = [(None, text, "x", 1), (5, text, "x", 1), (5, text, "x", 1), (7, text + " a b", "x", 1)]
    got = sorted(map(str, remove_repeats(brute.edge_docs(spark, rows)).select("doc_id", "n_words", "n_removed").collect()))
    want = [(5, 30, 30), (5, 30, 30), (7, 32, 30), (None, 30, 0)]
    assert got == sorted(f"Row(doc_id={a}, n_words={b}, n_removed={c})" for a, b, c in want)


def test_empty_table(spark):
    assert digests(brute.edge_docs(spark, [])).count() == 0


def test_columns_stay_and_gaps_are_kept(spark):
    rows = [(1, "p q  r\ns t", "x", 1), (2, "a\tb p q  r\ns t  z", "y", 2), (3, None, None, None)]
    got = remove_repeats(brute.edge_docs(spark, rows), 5)
    assert got.columns == ["doc_id", "text", "grp", "n", "n_words", "n_removed"]
    assert sorted(map(tuple, got.collect())) == [
        (1, "p q  r\ns t", "x", 1, 5, 0), (2, "a\tb z", "y", 2, 8, 5), (3, None, None, None, 0, 0)]


def test_windows_across_many_batches(spark, monkeypatch):
    docs = brute.corpus(FOLDER)[:60]
    rows = [(i, t, "s", 0) for i, t in docs]
    got = as_dict(digests(brute.edge_docs(spark, rows).repartition(17), width=5))
    assert got == dedup(docs, 5)


@pytest.mark.parametrize("keys,places", [([], []), ([3, 3, 9], [0, 7, 2]), ([-(1 << 63), 0, (1 << 62)], [5, 1, 4_000_000_000])])
def test_places_round_trip(keys, places):
    import numpy as np

    k, p = unpack_places(pack_places(np.array(keys, np.int64), np.array(places, np.int64)))
    assert (k.tolist(), p.tolist()) == (keys, places)
