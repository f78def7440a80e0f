import random

from freshet.llm import ngram_jaccard as nj
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def expected(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = lower(t).split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    ids, links = sorted(sets), {i: set() for i in sets}
    for x, a in enumerate(ids):
        for b in ids[:x]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                links[a].add(b)
                links[b].add(a)
    comp = {}
    for i in ids:
        if i not in comp:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = i
                    todo += links[x]
    return {i: (len(sets[i]), comp[i]) for i in ids}


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    assert as_dict(queries.op3_ngram_jaccard(spark, FOLDER)) == expected(brute.corpus(FOLDER), 3, 90)


def test_edge_texts(spark):
    assert as_dict(nj.jaccard_join(brute.edge_docs(spark))) == expected([(r[0], r[1]) for r in brute.edge_rows()], 3, 90)


def test_all_links(spark):
    docs = near_copies(30)
    got = {(r["a"], r["b"]) for r in nj.jaccard_links(brute.edge_docs(spark, [(i, t, "s", 0) for i, t in docs]), 5, 80).collect()}
    grams = {i: {tuple(t.split()[k:k + 5]) for k in range(56)} for i, t in docs}
    first = {}
    for i in sorted(grams):
        first.setdefault(frozenset(grams[i]), i)
    ids = sorted(first.values())
    assert got == {(a, b) for a in ids for b in ids if a < b and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])}


def near_copies(n, words=60, seed=5):
    pick = random.Random(seed)
    base = [f"w{pick.randint(0, 400)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(pick.randint(0, 3)):
            own[pick.randrange(words)] = f"q{pick.randint(0, 9)}"
        out.append((i, " ".join(own)))
    return out


def test_large_group_of_near_copies_over_tiles(spark, monkeypatch):
    monkeypatch.setattr(nj, "TILE_DOCS", 16)
    docs = near_copies(90)
    got = as_dict(nj.jaccard_join(brute.edge_docs(spark, [(i, t, "s", 0) for i, t in docs]), 5, 80))
    assert got == expected(docs, 5, 80)


def test_overlaps_by_column_blocks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(nj, "COLUMNS", 7)
    pick = random.Random(1)
    sets = [np.unique(np.array([pick.randint(0, 60) for _ in range(pick.randint(1, 50))], np.uint64)) for _ in range(40)]
    n = np.array(list(map(len, sets)))
    i, j = nj.overlaps(sets[:20], sets[20:], nj.link_bound(50, n[:20, None], n[None, 20:]))
    want = {(a, b) for a in range(20) for b in range(20)
            if 2 * len(np.intersect1d(sets[a], sets[20 + b])) >= len(np.union1d(sets[a], sets[20 + b]))}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_keep_one_and_nulls(spark):
    rows = [(None, "a b c d e f g", "x", 1), (3, "a b c d e f g", "y", 2), (4, "A b c d e f g", "y", 2), (4, "A b c d e f g", "y", 2),
            (5, "", "z", 3), (6, None, "z", 3)]
    kept = nj.keep_one(brute.edge_docs(spark, rows))
    assert sorted(map(str, kept.select("doc_id").collect())) == ["Row(doc_id=5)", "Row(doc_id=6)", "Row(doc_id=None)"]
    assert kept.columns == ["doc_id", "text", "grp", "n"]


def test_empty_table(spark):
    assert nj.jaccard_join(brute.edge_docs(spark, [])).count() == 0


def links_of(docs, width, percent):
    """The number of other documents that each document links to, by comparing all pairs."""
    sets = {}
    for i, t in docs:
        w = lower(t).split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    return {i: sum(1 for j in sets if j != i and sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))
            for i in sets}


def links_found(df):
    return {r["doc_id"]: r["n_links"] for r in df.collect()}


def test_number_of_links(spark):
    assert links_found(queries.op3_ngram_jaccard(spark, FOLDER)) == links_of(brute.corpus(FOLDER), 3, 90)
    assert links_found(nj.jaccard_join(brute.edge_docs(spark))) == links_of([(r[0], r[1]) for r in brute.edge_rows()], 3, 90)


def test_number_of_links_over_tiles_copies_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(nj, "TILE_DOCS", 8)
    docs = near_copies(90)
    docs += [(100 + i, t) for i, t in docs[:20]] + docs[5:15]  # equal texts, and rows that are there twice
    want = links_of(docs, 5, 80)
    assert len(set(want.values())) > 3
    assert links_found(nj.jaccard_join(brute.edge_docs(spark, [(i, t, "s", 0) for i, t in docs]), 5, 80)) == want


def test_packed_texts_are_unpacked_in_parts(monkeypatch):
    import pyarrow as pa

    from freshet.llm import ngram_jaccard

    seen, texts = [], [b"a b c d", b"", b"a b", b"x y z " * 50, b"a b c d e"]
    real = ngram_jaccard.gram_sets
    monkeypatch.setattr(ngram_jaccard, "unpack_text", lambda x: x)
    monkeypatch.setattr(ngram_jaccard, "gram_sets", lambda part, width: seen.append(len(part)) or real(part, width))
    got = [x.tolist() for x in ngram_jaccard.packed_sets(pa.chunked_array([pa.array(texts, pa.binary())]), 3, limit=100)]
    assert got == [x.tolist() for x in real(texts, 3)]
    assert seen == [4, 1]


def test_wanted_texts_pass_python_once(spark):
    docs = brute.edge_docs(spark, [(1, "a b c d", "s", 0), (None, "x y z", "s", 0), (2, "left out", "s", 0), (3, None, "s", 0)])
    key = nj.signatures(docs, 3, 90).where("doc_id < 0").first()["doc_id"]
    wanted = spark.createDataFrame([(1,), (key,), (3,)], "doc long")
    sets = nj._sets(docs, wanted, 3)
    assert sets._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r["doc"]: r["n"] for r in sets.collect()} == {1: 2, key: 1, 3: 0}


def test_arrays_kept_by_a_worker_are_small():
    from freshet.llm import common

    common.Words([b"a b c"])
    assert sum(x.nbytes for pair in common._power_cache.values() for x in pair) < 10_000_000
