"""Rows without doc_id are documents of their own: none loses words, bytes or itself to another that it does not repeat."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from freshet.llm import common, ngram_jaccard, secret_scan, substring_dedup, suffix_dedup
from tests.llm import brute

PLAIN = [" ".join(f"{name}{i}" for i in range(n)) for name, n in (("a", 60), ("b", 90), ("c", 70))]


def docs(spark, more=()):
    return brute.edge_docs(spark, [(None, t, "x", 1) for t in (*PLAIN, None, "")] + [*more])


def test_keys_agree_between_python_and_spark(spark):
    got = {r["text"]: r["k"] for r in docs(spark).withColumn("k", common.row_key()).collect()}
    assert all(k == common.null_key((t or "").encode()) < common.LEAST_ID for t, k in got.items())
    assert common.id_of(common.null_key(b"x")) is None and common.id_of(5) == 5
    assert [r[0] for r in brute.edge_docs(spark, [(7, "x", "x", 1)]).select(common.row_key()).collect()] == [7]


def test_no_words_are_lost(spark):
    rows = [(3, PLAIN[0] + " end", "x", 1), (4, "x " + PLAIN[1], "x", 1)]
    got = {(r["doc_id"], r["text"]): r["n_removed"] for r in substring_dedup.remove_repeats(docs(spark, rows)).collect()}
    assert all(got[None, t] == 0 for t in (*PLAIN, None, "")) and len(got) == 7
    assert sorted(n for (i, _), n in got.items() if i) == [60, 90]


def test_no_bytes_are_lost(spark):
    got = sorted((r["n_bytes"], r["n_removed"], r["kept"]) for r in suffix_dedup.remove_repeats(docs(spark)).collect())
    assert got == sorted((len((t or "").encode()), 0, (t or "").encode()) for t in (*PLAIN, None, ""))


def test_no_document_is_lost(spark):
    near = PLAIN[1] + " more"
    kept = ngram_jaccard.keep_one(docs(spark, [(5, near, "x", 1), (6, PLAIN[2], "x", 1), (6, PLAIN[2], "x", 1), (7, "other words here", "x", 1)]))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted(
        [(0, t) for t in (*PLAIN, "", "")] + [(7, "other words here")])
    joined = ngram_jaccard.jaccard_join(docs(spark), 5, 80)
    assert joined.where("doc_id IS NULL AND component_id IS NULL AND n_links = 0").count() == 5


@pytest.mark.parametrize("name", ["ngram_jaccard", "substring_dedup", "secret_scan"])
def test_stages_keep_rows_without_id(spark, name):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = table.limit(0).union(spark.createDataFrame([(None, t, "en", "s", len(t)) for t in PLAIN], table.schema))
    out = dict(corpus_pipeline.STAGES)[name](spark, rows, folder)
    assert sorted(r["text"] for r in out.collect()) == sorted(PLAIN)


def test_secrets_stay_with_their_text(spark):
    secret = "q7f3" * 10
    rows = spark.createDataFrame([(None, f'token = "{secret}"'), (None, "plain words 0123456789abcdef0123")], "doc_id long, text string")
    out = secret_scan.redact(rows.withColumn("source", F.lit("s")))
    assert out.columns == ["doc_id", "text", "source"] and out.count() == 2
    assert "plain words 0123456789abcdef0123" in {r["text"] for r in out.collect()}
