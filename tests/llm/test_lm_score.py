import math
from collections import Counter

import pytest

from freshet.llm import lm_score as lm
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def expected(docs, target, size=lm.VOCABULARY):
    counts = Counter(w for _, t in docs for w in brute.words_of(t))
    top = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]
    number, width = {w: k + 2 for k, w in enumerate(top)}, len(top) + 2
    models = [(Counter(), Counter()), (Counter(), Counter())]
    coded = {}
    for i, t in docs:
        ids = [number.get(w, 1) for w in brute.words_of(t)]
        coded[i] = list(zip([0, *ids], ids, strict=False))
        for k in (0, 1):
            if k or i in target:
                models[k][0].update(coded[i])
                models[k][1].update(v for v, _ in coded[i])
    out = {}
    for i, pairs in coded.items():
        loss = [sum(-math.log((m[0][p] + lm.ADD) / (m[1][p[0]] + lm.ADD * width)) for p in pairs) for m in models]
        n = len(pairs)
        out[i] = (n, loss[0] / n, loss[1] / n, (loss[0] - loss[1]) / n) if n else (0, None, None, None)
    return out


def check(df, want):
    got = {r[0]: tuple(r[1:]) for r in df.collect()}
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][0] == w[0] and all(a == b or a == pytest.approx(b, abs=1e-6) for a, b in zip(got[i][1:], w[1:], strict=True))


def test_query_equals_brute_force(spark):
    good = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    check(queries.op9_lm_score(spark, FOLDER), expected(brute.corpus(FOLDER), good))


def test_edge_texts_and_small_vocabulary(spark):
    docs = brute.edge_docs(spark)
    target = spark.createDataFrame([(6,), (6,), (99,), (None,)], "doc_id long")
    check(lm.cross_entropy_difference(docs, target, 5), expected([(r[0], r[1]) for r in brute.edge_rows()], {6, 99}, 5))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm.cross_entropy_difference(brute.edge_docs(spark, []), none).count() == 0
    assert lm.cross_entropy_difference(brute.edge_docs(spark), none).count() == len(brute.edge_rows())


def test_more_words_than_sixteen_bits_hold(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i * 2000, (i + 2) * 2000)), "s", 0) for i in range(36)]
    want = expected([r[:2] for r in rows], {0, 35}, None)
    assert len({w for r in rows for w in r[1].split()}) > 1 << 16
    target = spark.createDataFrame([(0,), (35,)], "doc_id long")
    check(lm.cross_entropy_difference(brute.edge_docs(spark, rows), target), want)
