import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators import simplify

POINT = "array<array<struct<x:double,y:double>>>"


def line(pick, n):
    return [(float(pick.randint(0, 30)), float(pick.randint(0, 30))) for _ in range(n)]


def split_recursively(points, tolerance):
    x, y = (np.array(c) for c in zip(*points, strict=True))
    keep = {0, len(points) - 1}

    def go(a, b):
        if b - a < 2:
            return
        gaps = [float(simplify._distance(x[a], y[a], x[b], y[b], x[i:i + 1], y[i:i + 1])[0]) for i in range(a + 1, b)]
        if max(gaps) > tolerance:
            m = a + 1 + gaps.index(max(gaps))
            keep.add(m)
            go(a, m)
            go(m, b)

    go(0, len(points) - 1)
    return sorted(keep)


def test_tolerance_of_many_lines_equals_recursion():
    pick = random.Random(2)
    lines = [line(pick, n) for n in [2, 3, 3, 4, 7, 40, 1, 300, 2, 5]]
    x, y = (np.array(c) for c in zip(*[p for one in lines for p in one], strict=True))
    sizes = np.array([len(one) for one in lines])
    starts = np.cumsum(sizes) - sizes
    keep = simplify._keep_by_tolerance(x, y, starts, sizes, 6.0)
    for one, a, n in zip(lines, starts, sizes, strict=True):
        assert np.flatnonzero(keep[a:a + n]).tolist() == split_recursively(one, 6.0)


@pytest.mark.parametrize("n", [3, 4, 5, 17, 120])
def test_areas_of_many_lines_equal_those_of_one(n):
    pick = random.Random(n)
    lines = [line(pick, n) for _ in range(30)]
    x, y = (np.array([[p[i] for p in one] for one in lines]) for i in (0, 1))
    together = simplify._effective_areas_together(x, y)
    for i in range(len(lines)):
        assert together[i].tolist() == simplify._effective_areas(x[i], y[i]).tolist()


def layer(spark, rows):
    return spark.createDataFrame([(s, i, [[{"x": a, "y": b} for a, b in p] for p in parts]) for i, (s, parts) in enumerate(rows)], f"section string, id long, geom {POINT}")


def test_kth_largest_of_every_key(spark):
    pick = random.Random(7)
    rows = [(k, float(pick.choice([0, 1, 2, 1e9, 1e-9, pick.random()]))) for k in ["a", "b", None] for _ in range(3000)] + [("one", 5.0), ("same", 1.0), ("same", 1.0)]
    df = spark.createDataFrame(rows, "key string, v double")
    for ask in (1, 2, 1500, 3000):
        ranks = spark.createDataFrame([(k, ask) for k in ("a", "b", None, "one", "same", "nobody")], "key string, k long")
        got = {r["key"]: r["bound"] for r in simplify.kth_largest_by(df, "key", "v", ranks).collect()}
        want = {}
        for key in ("a", "b", None, "one", "same"):
            values = sorted((v for k, v in rows if k == key), reverse=True)
            if ask <= len(values):
                want[key] = values[ask - 1]
        assert got == want


def test_each_section_keeps_its_own_share(spark):
    pick = random.Random(9)
    rows = [(s, [line(pick, pick.randint(1, 30)) for _ in range(pick.randint(1, 2))]) for s in ["a", "b", None] for _ in range(40)]
    rows.append(("few", [[(0.0, 0.0), (1.0, 1.0), (2.0, 0.0)]]))
    df = layer(spark, rows)
    got = simplify.simplify_by_section(df, "section", 0.25)
    assert got.columns == df.columns
    counted = F.aggregate("geom", F.lit(0), lambda a, p: a + F.greatest(F.size(p) - 2, F.lit(0)))
    before = {r[0]: r[1] for r in df.groupBy("section").agg(F.sum(counted)).collect()}
    after = {r[0]: r[1] for r in got.groupBy("section").agg(F.sum(counted)).collect()}
    assert after["few"] == 0
    for s in ("a", "b", None):
        assert round(0.25 * before[s]) <= after[s] < 0.25 * before[s] + 40
    ends = {r["id"]: [(p[0], p[-1]) for p in r["geom"]] for r in df.collect()}
    assert all([(p[0], p[-1]) for p in r["geom"]] == ends[r["id"]] for r in got.collect())


def test_one_section_equals_the_layer(spark):
    pick = random.Random(11)
    df = layer(spark, [("a", [line(pick, 25)]) for _ in range(30)])
    one, whole = (sorted(map(tuple, x.select("id", "geom").collect())) for x in (simplify.simplify_by_section(df, "section", 0.3), simplify.simplify_keep(df, 0.3)))
    assert one == whole


def test_empty_layer(spark):
    assert simplify.simplify_by_section(layer(spark, []), "section", 0.1).count() == 0
