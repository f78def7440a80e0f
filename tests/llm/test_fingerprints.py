import hashlib

from pyspark.sql import functions as F

from freshet.llm import fingerprints as fp
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def like(a, b):
    a, b = ({x for x in t.split("\n") if x} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    texts = [t or "" for _, t in docs]
    out = {}
    for k, (i, _) in enumerate(docs):
        own, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        out[i] = (len(own), hashlib.sha256(edited.encode()).hexdigest(), like(own, edited), like(own, after))
    return out


def check(df, docs):
    rows = df.collect()
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows}
    assert got == expected(docs)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(dict(docs)[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_query_equals_brute_force(spark):
    check(queries.op5_fingerprints(spark, FOLDER), brute.corpus(FOLDER))


def test_edge_texts(spark):
    check(fp.fingerprints(brute.edge_docs(spark)), [(r[0], r[1]) for r in brute.edge_rows()])


def test_peeling_recovers_the_difference_on_every_rung(spark):
    rows = [(k, list(range(n)), list(range(m, n + m))) for k, (n, m) in enumerate([(0, 0), (5, 2), (40, 3), (40, 30), (300, 280)])]
    df = spark.createDataFrame(rows, "k int, a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    ladder = [fp._difference_of(fp.sketch(a), fp.sketch(b)), *[fp._retry(a, b, per, cells, i + 1) for i, (per, cells) in enumerate(fp.LADDER)]]
    for r in df.select("k", "a", "b", *[x.alias(f"d{i}") for i, x in enumerate(ladder)]).collect():
        want = set(r["a"]) ^ set(r["b"])
        tried = [r[f"d{i}"] for i in range(len(ladder)) if r[f"d{i}"] is not None]
        assert tried and all(sorted(x) == sorted(want) for x in tried)
        assert (r["d0"] is None) == (len(want) > 20)


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = [(None, "a\nb", "x", 1), (2, "c\nd", "x", 1), (2, "c\nd", "x", 1)]
    got = fp.fingerprints(brute.edge_docs(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2", "2", "None"]
    assert {r["edited_sha256"] for r in got if r["doc_id"] == 2} == {hashlib.sha256(b"c\na").hexdigest()}
    empty = fp.fingerprints(brute.edge_docs(spark, []))
    assert empty.count() == 0


def test_plan_is_native(spark):
    plan = fp.fingerprints(brute.edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
