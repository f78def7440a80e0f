import re
from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_ngram_jaccard import expected as near
from tests.llm.test_quality_rules import expected as quality

FOLDER = "/root/testdata/sf0.01"
TOKEN = re.compile(r'(?i)(token = ")[0-9a-f]{40}(")')


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    held = brute.corpus(FOLDER)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        if name != names[-1]:
            assert docs.columns == columns
            rows = docs.collect()
            found[name] = {r["doc_id"]: r["text"] for r in rows}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
            docs = spark.createDataFrame(rows, docs.schema)
    held = [(i, t) for i, t in held if quality(t)["failed"] == 0]
    assert found["quality_rules"] == dict(held)
    comp = near(held, 5, 80)
    held = [(i, t) for i, t in held if comp[i][1] == i]
    assert found["ngram_jaccard"] == dict(held)
    cut = brute.substring_dedup(held)
    kept = {i: brute.kept_words(t, cut[i][3]) for i, t in held if cut[i][1] == 0 or cut[i][1] < cut[i][0]}
    assert {i: t.encode().split() for i, t in found["substring_dedup"].items()} == kept
    held = found["substring_dedup"]
    assert found["secret_scan"] == {i: TOKEN.sub(r"\1[SECRET]\2", t) for i, t in held.items()}
    packed = Counter()
    for r in docs.collect():
        packed[r["doc_id"]] += r["n_words"]
    assert packed == {i: len(t.encode().split()) for i, t in found["secret_scan"].items()}


def test_run_has_the_rows_of_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["bin"] is not None for r in rows)
