import random
import re

import duckdb
from pyspark.sql import functions as F

from freshet.llm import license_scan as ls
from freshet.llm import queries
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
END = re.compile("(?<=[.;:!?])[\\x20\\x09-\\x0D]+|\\n[\\x20\\x09\\x0B-\\x0D]*\\n")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(text, notices=ls.NOTICES, threshold=ls.THRESHOLD):
    words, places, base, found, score = words_of(text), [], set(), set(), 0.0
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    for block in END.split(text or ""):
        held = set(words_of(block))
        for label, notice in notices:
            want = set(words_of(notice))
            if 100 * len(held & want) >= threshold * len(want):
                found.add(label)
                score = max(score, len(held & want) / len(want))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), score)


EDGE = [
    "cc by", "CC BY-NC 4.0", "cc by cc by cc", "mit licenses", "the MIT License, mit\nlicense", "GNU General\n\nPublic License.",
    "apache license apache LICENSE", "Key İ MIT LICENSE", "xmit license", "mit licensé", "license mit",
    "Licensed under CC BY-SA 4.0.", "Text before. Licensed under the Apache License, Version 2.0. Text after", "Version 2.0 of the Apache License: licensed under",
    "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation", "Released under the\n\nMIT License", "released UNDER the MIT license " * 300,
    "Redistribution and use in source and binary forms, are permitted provided that the following conditions are met",
]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark):
    got = as_rows(queries.op12_license_scan(spark, FOLDER))
    assert got == sorted(((i, *expected(t)) for i, t in brute.corpus(FOLDER)), key=repr)
    assert any(r[6] not in ("", r[5]) for r in got)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert sorted(con.execute(ls.oracle_sql()).fetchall(), key=repr) == got


def test_edge_texts_null_and_shared_ids(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate([*brute.EDGE_TEXTS, *EDGE])]
    rows += [(None, EDGE[0], "x", 1), (None, EDGE[4], "x", 1), (None, None, "x", 1), (5, EDGE[6], "x", 1), (5, EDGE[6], "x", 1), (5, "none", "x", 1)]
    assert as_rows(ls.license_scan(brute.edge_docs(spark, rows))) == sorted(((i, *expected(t)) for i, t, *_ in rows), key=repr)


def test_join_equals_all_pairs_on_random_sets(spark):
    pick = random.Random(5)
    letters = "abcdefghij"
    notices = [(f"l{k}", " ".join(pick.sample(letters, pick.randint(1, 7)))) for k in range(12)]
    rows = [(i, " ".join(pick.choices(letters, weights=range(1, 11), k=pick.randint(0, 9))), "x", 0) for i in range(150)]
    for threshold in (50, 70, 100):
        docs = brute.edge_docs(spark, rows).select("doc_id", F.col("text").alias("__text"))
        got = sorted((r["doc_id"], r["notice"], r["shared"]) for r in ls.find_blocks(docs, notices, threshold).collect())
        want = [(i, k, len(set(t.split()) & set(n.split()))) for i, t, *_ in rows for k, (_, n) in enumerate(notices)
                if 100 * len(set(t.split()) & set(n.split())) >= threshold * len(set(n.split()))]
        assert got == sorted(want)


def test_blocks_keep_their_text(spark):
    docs = spark.createDataFrame([("a", "Some words. Released under the MIT License. More.")], "name string, __text string")
    assert [tuple(r) for r in ls.find_blocks(docs).collect()] == [("a", 1, "Released under the MIT License.", 10, "mit", 5, 5)]


def test_empty_table_and_plan(spark):
    assert ls.license_scan(brute.edge_docs(spark, [])).count() == 0
    clash = spark.createDataFrame([(1, "mit license", "a", 9.0)], "doc_id long, text string, labels string, score double")
    assert as_rows(ls.license_scan(clash)) == [(1, *expected("mit license"))]
    plan = ls.license_scan(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
