import random
from collections import defaultdict

from freshet.llm import best_fit_packing as p
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def slow_pack(pieces, capacity):
    bins, out = [], []
    for n, s, c in pieces:
        fits = [(room, k) for k, (room, ss, cc) in enumerate(bins) if room >= n and not (s is not None and s in ss) and not (c is not None and c in cc)]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append([capacity, set(), set()])
        bins[k][0] -= n
        bins[k][1].add(s)
        bins[k][2].add(c)
        out.append(k)
    return out


def test_shard_equals_exhaustive_best_fit():
    pick = random.Random(2)
    for _ in range(30):
        pieces = sorted(((pick.randint(1, 50), pick.choice([None, "a", "a", "b", "c"]), pick.choice([None, 1, 2, 3])) for _ in range(200)),
                        key=lambda x: -x[0])
        assert p.pack_shard(pieces, 50) == slow_pack(pieces, 50)


def valid(rows, docs, capacity):
    bins, words = defaultdict(list), defaultdict(int)
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        assert (r["bin"] is None) == (r["n_words"] == 0)
        if r["n_words"]:
            bins[r["bin"]].append(r)
    assert dict(words) == {i: len(brute.words_of(t)) for i, t in docs}
    for own in bins.values():
        assert sum(r["n_words"] for r in own) <= capacity
        for c in ("source", "cluster"):
            known = [r[c] for r in own if r[c] is not None]
            assert len(known) == len(set(known))
    return bins


def test_query_is_a_valid_packing(spark):
    rows = queries.op6_best_fit_packing(spark, FOLDER).collect()
    bins = valid(rows, brute.corpus(FOLDER), p.CAPACITY)
    assert sum(r["n_words"] for r in rows) / (len(bins) * p.CAPACITY) > 0.6


def test_edge_texts_and_long_documents(spark):
    rows = p.pack(brute.edge_docs(spark), 64, "grp").collect()
    valid(rows, [(r[0], r[1]) for r in brute.edge_rows()], 64)
    assert sum(r["doc_id"] == 12 for r in rows) == 47


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(None, "a b c", None, 1), (None, "a b c", None, 1), (9, None, "s", 1)]
    got = p.pack(brute.edge_docs(spark, rows), 64, "grp").collect()
    assert len(got) == 3 and len({r["bin"] for r in got if r["n_words"]}) == 2
    assert p.pack(brute.edge_docs(spark, []), 64, "grp").count() == 0
