import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from freshet.operators import chains
from freshet.operators.geometry import canonical

SCHEMA = "key string, ax double, ay double, bx double, by double"


def table(spark, rows):
    return canonical(spark.createDataFrame(rows, SCHEMA)).distinct()


def walk(edges):
    """Parts of one key as vertex lists, by walking."""
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    nodes, used, parts = {v for v in near if len(near[v]) != 2}, set(), []

    def follow(a, b):
        path = [a, b]
        while path[-1] not in nodes and path[-1] != path[0]:
            path.append(next(w for w in near[path[-1]] if w != path[-2]))
        used.update(frozenset(e) for e in zip(path, path[1:], strict=False))
        return path

    def add(path):
        back = path[::-1]
        parts.append(min(path, back, key=lambda p: (p[0], p[1])))

    for a in sorted(nodes):
        for b in sorted(near[a]):
            if frozenset((a, b)) not in used:
                add(follow(a, b))
    for a in sorted(near):
        for b in sorted(near[a]):
            if frozenset((a, b)) not in used:
                add(follow(a, b))
    return sorted(parts)


def found(df):
    lines = chains.part_lines(chains.chain_parts(df, "key"), "key").collect()
    out = defaultdict(list)
    for r in lines:
        path = [(v["x"], v["y"]) for v in r["geom"][0]]
        assert (r["part"]["x"], r["part"]["y"]) == path[0] and (r["part"]["next_x"], r["part"]["next_y"]) == path[1]
        assert r["n_edges"] == len(path) - 1
        out[r["key"]].append(path)
    return {k: sorted(v) for k, v in out.items()}


def test_random_graphs_equal_walking(spark):
    pick = random.Random(1)
    rows = []
    for key in [None, "a", "b", "c", "d", "e"]:
        for _ in range(pick.randint(1, 25)):
            a = (float(pick.randint(0, 4)), float(pick.randint(0, 3)))
            b = (a[0] + pick.choice([-1, 0, 1]), a[1] + pick.choice([-1, 0, 1]))
            rows.append((key, *a, *b))
    got = found(table(spark, rows))
    for key in {r[0] for r in rows}:
        want = walk({((r[1], r[2]), (r[3], r[4])) for r in rows if r[0] == key})
        assert got.get(key, []) == want


@pytest.mark.parametrize("limit, large", [(1, 10**6), (9, 1), (10**6, 2)])
def test_lines_that_leave_their_chunk(spark, monkeypatch, limit, large):
    monkeypatch.setattr(chains, "CHUNK", limit)
    monkeypatch.setattr(chains, "LARGE", large)
    monkeypatch.setattr(chains, "BLOCK", 2)
    pick = random.Random(5)
    rows = [("r", *map(float, e)) for e in ((0, 0, 5, 0), (5, 0, 5, 5), (5, 5, 0, 5), (0, 5, 0, 0), (9, 9, 19, 9))]
    for key in [None, "a", "b"]:
        for _ in range(30):
            a = (float(pick.randint(0, 6)), float(pick.randint(0, 4)))
            rows.append((key, *a, a[0] + pick.choice([-1, 0, 1]), a[1] + pick.choice([-1, 0, 1])))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        got = found(table(spark, rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for key in {r[0] for r in rows}:
        assert got.get(key, []) == walk({((r[1], r[2]), (r[3], r[4])) for r in rows if r[0] == key})


def test_short_parts_take_no_rounds(spark):
    ways = [(k, i, float(k * 7919 % 100 + i), float(i * i % 5)) for k in range(50) for i in range(30)]
    rows = [(f"k{k}", x, y, float(k * 7919 % 100 + i + 1), float((i + 1) ** 2 % 5)) for k, i, x, y in ways]
    rounds = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        parts = chains.chain_parts(table(spark, rows), "key", rounds=rounds)
        assert parts.groupBy("key").agg(F.max("n_edges").alias("n")).where("n = 30").count() == 50
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rounds == []


def test_a_layer_without_keys(spark):
    rows = [("k", *map(float, e)) for e in ((0, 0, 1, 0), (1, 0, 2, 1), (5, 5, 6, 5), (6, 5, 6, 6), (6, 6, 5, 5))]
    parts = chains.chain_parts(table(spark, rows).drop("key"), [])
    assert sorted(tuple(r) for r in parts.groupBy("part.x", "n_edges").count().collect()) == [(0.0, 2, 2), (5.0, 3, 3)]


def test_rings_loops_and_single_edges(spark):
    ring = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    loop = [(5, 5), (6, 5), (6, 6), (5, 5), (4, 4)]
    rows = [("k", *map(float, (*a, *b))) for path in (ring, loop, [(9, 9), (8, 8)], [(7, 7), (7, 7)]) for a, b in zip(path, path[1:], strict=False)]
    assert found(table(spark, rows)) == {"k": sorted(
        [[(float(x), float(y)) for x, y in p] for p in ([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)],
                                                       [(4, 4), (5, 5)], [(8, 8), (9, 9)])])}


def test_a_long_chain_takes_few_rounds(spark):
    n, rounds = 100_000, []
    i = F.col("id").cast("double")
    df = spark.range(n).select(F.lit("k").alias("key"), i.alias("ax"), F.lit(0.0).alias("ay"), (i + 1).alias("bx"), F.lit(0.0).alias("by"))
    parts = chains.chain_parts(df, "key", rounds=rounds)
    assert parts.agg(F.min("n_edges"), F.max("n_edges"), F.min(F.col("place") == F.col("ax")), F.countDistinct("part")).first() == (n, n, True, 1)
    assert len(rounds) <= 18


def test_a_long_ring(spark):
    n = 3_000
    rows = [("k", float(i), float(i % 7), float((i + 1) % n), float((i + 1) % n % 7)) for i in range(n)]
    (part,) = chains.chain_parts(table(spark, rows), "key").groupBy("part").agg(F.count("*"), F.max("place")).collect()
    assert tuple(part[0]) == (0.0, 0.0, 1.0, 1.0) and part[1:] == (n, n - 1)


def test_empty_table(spark):
    assert found(table(spark, [])) == {}
