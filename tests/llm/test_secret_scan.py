import random
import re

import pytest
from pyspark.sql import functions as F

from freshet.llm import queries
from freshet.llm import secret_scan as s
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=\-])(?=[A-Za-z0-9_+/=\-]*[0-9])[A-Za-z0-9_+/=\-]{16,}")


@pytest.fixture(scope="module")
def scanned(spark):
    return queries.op1_secret_scan(spark, FOLDER).collect()


def test_findings_are_those_of_the_pattern(spark, scanned):
    want = sorted((i, m.start(), len(m.group())) for i, t in brute.corpus(FOLDER) for m in CANDIDATE.finditer(t))
    assert sorted((r["doc_id"], r["start"], r["n_chars"]) for r in scanned) == want


def test_tokens_are_secrets_and_numbers_are_not(scanned):
    texts = dict(brute.corpus(FOLDER))
    for r in scanned:
        word = texts[r["doc_id"]][r["start"]:r["start"] + r["n_chars"]]
        assert r["is_secret"] == (not word.isdigit()), word


def test_held_out_accuracy(spark):
    pick = random.Random(8)
    hexa = lambda n: "".join(pick.choice("0123456789abcdef") for _ in range(n))
    b64 = lambda n: "".join(pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n)) + "7"
    rows, truth = [], {}
    for i in range(400):
        kind = i % 4
        text = {0: f'client api_key = "{hexa(32)}" for the host', 1: f"export SECRET={b64(30)} before the start",
                2: f"order number {pick.randint(10**15, 10**16)} was paid today", 3: f"see the page another-simple-running-title-{i} for more of these"}[kind]
        rows.append((i, text, "src", 0))
        truth[i] = kind < 2
    docs = brute.edge_docs(spark, rows)
    words = docs.sparkSession.createDataFrame([("simple",), ("another",), ("running",), ("title",)], "word string")
    found = s.featurize(s.findings(docs, "grp"), words)
    label = F.when(F.col("doc_id") % 4 < 2, 1.0).otherwise(0.0)
    model = s.train(found.where("doc_id < 200").withColumn("label", label))
    held = s.score(found.where("doc_id >= 200"), model).select("doc_id", "p_secret").collect()
    right = sum((r["p_secret"] >= 0.5) == truth[r["doc_id"]] for r in held)
    assert len(held) == 200 and right >= 190


def test_redaction_keeps_everything_else(spark):
    secret = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    rows = [(1, f'x token = "{secret}" y token = "{secret}"', "p", 1), (2, "card 9807915762804490 here", "p", 2), (3, None, None, None),
            (None, "", "q", 4), (1, f"again {secret}", "p", 5)]
    got = s.redact(brute.edge_docs(spark, rows), path="grp")
    assert got.columns == ["doc_id", "text", "grp", "n"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (1, 'x token = "[SECRET]" y token = "[SECRET]"', "p", 1), (2, "card 9807915762804490 here", "p", 2), (3, None, None, None),
        (None, "", "q", 4), (1, "again [SECRET]", "p", 5)], key=repr)


def test_empty_table_edge_texts_and_plan(spark):
    assert s.scan(brute.edge_docs(spark, [])).count() == 0
    assert s.scan(brute.edge_docs(spark)).count() == 0
    plan = s.scan(brute.edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_without_both_labels_nothing_without_evidence_is_redacted(spark):
    rows = [(i, f"build 7f3a9c2e51d{i:02d}b8e604 of today, order {10**16 + i} was paid", "src", 0) for i in range(5)]
    docs = brute.edge_docs(spark, rows)
    assert {r["text"] for r in s.redact(docs).collect()} == {r[1] for r in rows}
    none = spark.createDataFrame([], "doc_id long")
    assert s.scan(docs, reviewed=none).where("is_secret").count() == 0


def test_copies_of_a_finding_do_not_fill_the_sample(spark):
    texts = [f"number {k}7f3a9c2e51d0b8e604 here" for k in range(7)]
    hashes = s.findings(brute.edge_docs(spark, [(i, t, "s", 0) for i, t in enumerate(texts)]), "grp")
    by_hash = [r["doc_id"] for r in hashes.orderBy(F.xxhash64("finding", "before", "after")).collect()]
    last = by_hash[-1]  # the only one with its label
    rows = [(i, t, "s", k) for i, t in enumerate(texts) for k in range(1 if i == last else 30)]
    words = spark.createDataFrame([], "word string")
    found = s.featurize(s.findings(brute.edge_docs(spark, rows), "grp"), words)
    assert s.train(found.withColumn("label", (F.col("doc_id") == last).cast("double")), rows=20) is not None
