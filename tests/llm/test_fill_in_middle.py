import hashlib
import re

import duckdb
import pytest

from freshet.llm import fill_in_middle as fim
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
UNIT = re.compile("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+")


def expected(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h1, h2, h3, h4 = fim.draws(key, 42)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (n, "plain", None, None, sha(text), sha(text))
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (n, form, len(p), len(m), sha(out), sha(text))


def run(docs, **options):
    return sorted(map(tuple, fim.digests(fim.fill_in_middle(fim.store_frames(docs, **options))).collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(tuple(r) for r in queries.op13_fill_in_middle(spark, FOLDER).collect())
    assert got == sorted((i, *expected(i, t)) for i, t in brute.corpus(FOLDER))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert sorted(con.execute(fim.ORACLE_SQL).fetchall()) == got


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 16])
def test_edge_texts_in_frames_of_any_size(spark, size):
    texts = [*brute.EDGE_TEXTS[:-1], "a<P>b", "x<S", "<M", "<", " lead", "trail ", "\n", "a b  c", "<<S <P M> " * 5, "word " * 50]
    rows = [(7 * i + k, t, "clash", 0) for i, t in enumerate(texts) for k in range(7)]
    rows += [(None, "null id text here", "x", 1), (None, None, "x", 1), (3, "shared id", "x", 1), (3, "other words", "x", 1)]
    got = run(brute.edge_docs(spark, rows), frame_bytes=size)
    assert got == sorted(((i, *expected(i, t)) for i, t, *_ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_long_text_keeps_most_frames(spark):
    text = " ".join(f"wörd{i}" for i in range(200_000)) + "x" * 300_000
    rows = [(i, text, "x", 0) for i in range(6)]
    stored = fim.store_frames(brute.edge_docs(spark, rows))
    moved = fim.fill_in_middle(stored).where("form <> 'plain'")
    frames = stored.first()["frames"]
    for r in moved.collect():
        assert sum(f in set(frames) for f in r["output"]) >= len(frames) - 2
    assert sorted(map(tuple, fim.digests(moved).collect())) == [x for x in ((i, *expected(i, text)) for i in range(6)) if x[2] != "plain"]


def test_empty_table_and_clashing_columns(spark):
    assert run(brute.edge_docs(spark, [])) == []
    docs = spark.createDataFrame([(1, "a b c d", "f", [b"x"], 5)], "doc_id long, text string, form string, frames array<binary>, n long")
    assert run(docs) == [(1, *expected(1, "a b c d"))]
