"""Lengths, dissolving, simplification, projection, boundaries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.operators import geometry, simplify

GEOM = "array<array<struct<x:double,y:double>>>"


def layer(spark, rows, extra="id int"):
    return spark.createDataFrame(
        [(*r[:-1], [[{"x": float(x), "y": float(y)} for x, y in part] for part in r[-1]]) for r in rows], f"{extra}, geom {GEOM}")


def test_length(spark):
    df = layer(spark, [(1, [[(0, 0), (3, 4), (3, 10)], [(0, 0), (1, 0)]]), (2, [[(5, 5)]])])
    assert {r.id: r.length_m for r in geometry.with_length(df).collect()} == {1: 12.0, 2: 0.0}


def test_dissolve_keeps_each_edge_once(spark):
    df = layer(spark, [("a", [[(0, 0), (3, 4)]]), ("a", [[(3, 4), (0, 0), (0, 2)]]), (None, [[(0, 0), (3, 4)]])], "k string")
    sizes = {r.k: (r.n_edges, r.length_m) for r in geometry.dissolved_size(geometry.dissolve(df, ["k"]), "k").collect()}
    assert sizes == {"a": (2, 7.0), None: (1, 5.0)}


def test_drop_z(spark):
    df = spark.createDataFrame([([[{"x": 1.0, "y": 2.0, "z": 3.0}]],)], "geom array<array<struct<x:double,y:double,z:double>>>")
    assert geometry.drop_z(df).schema["geom"].dataType.simpleString() == GEOM


def test_boundary(spark):
    df = layer(spark, [(1, [[(0, 0), (1, 1), (2, 0)]]), (2, [[(0, 0), (1, 1), (2, 0), (0, 0)]]), (3, [[(0, 0), (1, 1)], [(1, 1), (5, 5)]])])
    ends = {}
    for r in geometry.boundary_points(df, "id").collect():
        ends.setdefault(r.id, set()).add((r.x, r.y))
    assert ends == {1: {(0, 0), (2, 0)}, 3: {(0, 0), (5, 5)}}


def test_geometry_hash_ignores_direction(spark):
    df = layer(spark, [(1, [[(0, 0), (1, 1), (2, 0)]]), (2, [[(2, 0), (1, 1), (0, 0)]]), (3, [[(0, 0), (1, 1)]])])
    h = {r.id: r.geom_hash for r in geometry.geom_hash(df).collect()}
    assert h[1] == h[2] != h[3]


def test_projection_round_trip(spark):
    grid = spark.range(0, 12).crossJoin(spark.range(0, 12).withColumnRenamed("id", "j")).select(
        (F.col("id") * 150_000.0).alias("x"), (F.col("j") * 150_000.0).alias("y"), F.col("id").alias("i"), "j")
    there = geometry.reproject(grid, 3005, 4326)
    back = geometry.reproject(there, 4326, 3005)
    worst = back.select(F.max(F.greatest(F.abs(F.col("x") - F.col("i") * 150_000), F.abs(F.col("y") - F.col("j") * 150_000)))).first()[0]
    assert worst < 1e-3
    origin = geometry.reproject(spark.createDataFrame([(-126.0, 45.0)], "x double, y double"), 4326, 3005).first()
    assert origin.x == pytest.approx(1_000_000, abs=1e-6) and origin.y == pytest.approx(0, abs=1e-6)


def wiggly(spark, n=40, size=30):
    r = np.random.default_rng(5)
    return layer(spark, [(i, [np.cumsum(r.normal(0, 20, (size, 2)), axis=0).tolist()]) for i in range(n)])


def test_tolerance_simplification(spark):
    df = wiggly(spark)
    before = {r.id: [tuple(p) for p in r.geom[0]] for r in df.collect()}
    after = {r.id: [tuple(p) for p in r.geom[0]] for r in simplify.simplify_tolerance(df, 25).collect()}
    for i, line in after.items():
        assert line[0] == before[i][0] and line[-1] == before[i][-1]
        assert set(line) <= set(before[i]) and len(line) < len(before[i])
    assert {r.id: len(r.geom[0]) for r in simplify.simplify_tolerance(df, 0).collect()} == {i: 30 for i in before}


def test_share_simplification_is_global(spark):
    df = wiggly(spark)
    inner = 40 * 28
    for share in (0.025, 0.5):
        kept = simplify.simplify_keep(df, share).select(F.sum(F.size(F.col("geom")[0]) - 2)).first()[0]
        assert round(share * inner) <= kept <= round(share * inner) + 40
    assert simplify.simplify_keep(df, 0).select(F.max(F.size(F.col("geom")[0]))).first()[0] == 2


def test_exact_rank_selection(spark):
    values = np.random.default_rng(1).exponential(10, 3000).tolist() + [5.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 17, 1750, len(values)):
        assert simplify.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert simplify.kth_largest(df, "v", len(values) + 1) is None


def test_repeated_edges_do_not_cancel_in_fingerprints(spark):
    rows = [(1, 0.0, 0.0, 1.0, 0.0), (1, 0.0, 0.0, 1.0, 0.0), (1, 5.0, 5.0, 6.0, 5.0),
            (2, 2.0, 0.0, 3.0, 0.0), (2, 2.0, 0.0, 3.0, 0.0), (2, 5.0, 5.0, 6.0, 5.0)]
    table = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} double" for c in geometry.EDGE))
    a, b = geometry.edge_fingerprint(table, "k").orderBy("k").collect()
    assert a.n_edges == b.n_edges == 3 and (a.h1, a.h2) != (b.h1, b.h2)


def test_edges_of_computed_lines_are_not_tested_below_the_exchange(spark):
    rows = spark.createDataFrame([(1, 4), (2, 1), (3, 0), (4, None)], "k long, n int").repartition(3, "k")
    vertex = "x -> named_struct('x', cast(x AS double), 'y', cast(k AS double))"
    lines = rows.selectExpr("k", f"CASE WHEN n > 0 THEN array(transform(sequence(1, n), {vertex})) WHEN n = 0 THEN array() END AS geom")
    for table in (geometry.edges(lines, ["k"]), geometry.part_edges(lines, ["k"]), geometry.line_pieces(lines, ["k"], 2)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "transform" not in plan[plan.index("RepartitionByExpression"):]
        assert {r.k for r in table.collect()} == {1}
    assert geometry.edges(lines, ["k"]).count() == 3
