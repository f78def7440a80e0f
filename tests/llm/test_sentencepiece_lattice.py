from collections import Counter

import public_tokenizers
import pytest

from freshet.llm import queries
from freshet.llm import sentencepiece_lattice as sl
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    pieces, first = sl.piece_table(spark, str(public_tokenizers.path("piece_bpe_32k.model")))
    return pieces, first, {r["piece"]: (r["id"], r["score"]) for r in pieces.collect()}


def viterbi(word, table, first):
    text = sl.MARK + word
    longest, worst = max(map(len, table)), min(s for _, s in table.values())
    best = [(0.0, 0, -1, "")]
    for e in range(1, len(text) + 1):
        reach = []
        for b in range(max(0, e - longest), e):
            i, score = table.get(text[b:e], (-1, worst - sl.UNKNOWN_COST))
            if i >= 0 or b == e - 1:
                reach.append((best[b][0] + score, -b, i, text[b:e]))
        best.append(max(reach))
    ids, at = [], len(text)
    while at:
        _, back, i, piece = best[at]
        ids[:0] = [i] if i >= 0 else [x + first for x in piece.encode()]
        at = -back
    return ids


def test_query_equals_brute_force(spark, model):
    _, first, table = model
    counts = Counter(w.decode() for _, t in brute.corpus(FOLDER) for w in brute.words_of(t))
    rows = queries.op4_sentencepiece(spark, FOLDER).collect()
    assert {r["word"]: r["n_words"] for r in rows} == counts
    for r in rows:
        assert r["decoded"] == r["word"] and [int(x) for x in r["ids"].split()] == viterbi(r["word"], table, first)


def test_documents_round_trip(spark, model):
    pieces, first, _ = model
    docs = brute.edge_docs(spark)
    coded = sl.encode_documents(docs, pieces, first)
    assert coded.count() == len(brute.EDGE_TEXTS)
    text = {r["doc_id"]: r["text"] for r in sl.decode_ids(coded, pieces, first, key="doc_id").collect()}
    assert text == {i: " ".join(w.decode() for w in brute.words_of(t)) for i, t, *_ in brute.edge_rows() if brute.words_of(t)}


def test_empty_table(spark, model):
    pieces, first, _ = model
    assert sl.encode_words(sl.distinct_words(brute.edge_docs(spark, [])), pieces, first).count() == 0


def test_lattice_adds_no_shuffle(spark, model):
    pieces, first, _ = model
    plan = sl.encode_words(sl.distinct_words(brute.edge_docs(spark)), pieces, first)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_every_document_is_encoded_and_decoded(spark, model):
    _, first, table = model
    texts, known = dict(brute.corpus(FOLDER)), {}
    rows = queries.registry()["op4_document_round_trip"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        words = [w.decode() for w in brute.words_of(texts[r["doc_id"]])]
        for w in words:
            if w not in known:
                known[w] = viterbi(w, table, first)
        assert r["decoded"] == " ".join(words) and r["n_words"] == len(words)
        assert r["ids"] == [i for w in words for i in known[w]] and r["n_ids"] == len(r["ids"])


def test_round_trip_of_edge_texts_null_ids_and_repeated_rows(spark, model):
    pieces, first, table = model
    rows = [*brute.edge_rows(), (None, "one two", "s", 0), (4, "other words", "s", 0)]
    got = sl.round_trip(brute.edge_docs(spark, rows), pieces, first).select("doc_id", "ids", "decoded").collect()
    words = {k: [w.decode() for w in brute.words_of(r[1])] for k, r in enumerate(rows)}
    want = [(r[0], [i for w in words[k] for i in viterbi(w, table, first)], " ".join(words[k])) for k, r in enumerate(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sl.round_trip(brute.edge_docs(spark, []), pieces, first).count() == 0
