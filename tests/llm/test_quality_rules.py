import random
from collections import Counter

import duckdb
import pytest

from freshet.llm import queries
from freshet.llm import quality_rules as q
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def expected(text):
    text = text or ""
    words = [w.decode() for w in brute.words_of(text)]
    lines = [x for x in text.split("\n") if brute.words_of(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = [False] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            hit[i:i + 5] = [True] * 5
    n = len(words)
    m = {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": sum(hit), "n_lines": len(lines),
         "n_capitals": sum("A" <= c <= "Z" for c in text)}
    fails = [n < 10, 100 * m["n_repeat_words"] > 20 * n, 10 * m["n_symbols"] > n, 2 * m["n_dup_lines"] > m["n_lines"],
             m["word_chars"] < 2 * n or m["word_chars"] > 12 * n, 2 * m["n_capitals"] > m["word_chars"]]
    return m | {"failed": sum(1 << k for k, f in enumerate(fails) if f)}


def check(df, docs):
    got = {r["doc_id"]: r.asDict() for r in df.collect()}
    assert set(got) == {i for i, _ in docs}
    for i, text in docs:
        want = expected(text)
        base = want["failed"] & 3 != 0
        assert {k: got[i][k] for k in want} == want, i
        assert (got[i]["base_failed"], got[i]["kept"]) == (base, not base and want["failed"] == 0)


def test_query_equals_brute_force(spark):
    check(queries.op8_quality_rules(spark, FOLDER), brute.corpus(FOLDER))


def test_edge_texts(spark):
    docs = brute.edge_docs(spark)
    check(q.verdicts(q.ledger(docs)), [(r[0], r[1]) for r in brute.edge_rows()])


def test_random_repeats(spark):
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice("ab") for _ in range(pick.randint(0, 40))), "x", 0) for i in range(60)]
    check(q.verdicts(q.ledger(brute.edge_docs(spark, rows))), [(r[0], r[1]) for r in rows])


def test_ablations(spark):
    docs = brute.corpus(FOLDER)
    got = {(r["policy"], r["rule"]): (r["kept"], r["kept_without"], r["rejected_alone"])
           for r in q.ablations(q.ledger(brute.edge_docs(spark, [(i, t, "s", 0) for i, t in docs]))).collect()}
    failed = [expected(t)["failed"] for _, t in docs]
    for (policy, rule), found in got.items():
        m, b = q.policy_mask(policy), q.rule_bit(rule)
        assert found == (sum(f & m == 0 for f in failed), sum(f & m & ~b == 0 for f in failed), sum(f & m == b for f in failed))
    assert len(got) == sum(map(len, q.POLICIES.values()))


def test_kept_documents_keep_their_columns(spark):
    docs = brute.edge_docs(spark)
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t, *_ in brute.edge_rows() if expected(t)["failed"] == 0}


def test_empty_table_and_plan(spark):
    docs = brute.edge_docs(spark, [])
    assert q.verdicts(q.ledger(docs)).count() == 0
    assert q.ablations(q.ledger(docs)).count() == 0
    plan = q.verdicts(q.ledger(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("query, sql", [(queries.op8_quality_rules, q.ORACLE_SQL), (queries.quality_ablations, q.ABLATION_SQL)])
def test_queries_equal_sql(spark, query, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    df = query(spark, FOLDER)
    found = con.sql(sql)
    assert found.columns == df.columns
    assert sorted(found.fetchall()) == sorted(tuple(r) for r in df.collect())


def test_edge_texts_equal_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in brute.edge_rows()])
    got = q.verdicts(q.ledger(brute.edge_docs(spark)))
    want = con.sql(q.ORACLE_SQL)
    assert sorted(want.fetchall()) == sorted(tuple(r) for r in got.select(*want.columns).collect())
