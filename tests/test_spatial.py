"""Grid-cell joins against brute force, with and without dense cells."""

import random

import pytest
from pyspark.sql import functions as F

from freshet.operators import geometry, spatial


def segment_distance2(a, b, p):
    ab, ap = (b[0] - a[0], b[1] - a[1]), (p[0] - a[0], p[1] - a[1])
    length2 = ab[0] ** 2 + ab[1] ** 2
    t = max(0.0, min(1.0, (ap[0] * ab[0] + ap[1] * ab[1]) / length2)) if length2 else 0.0
    return (ap[0] - t * ab[0]) ** 2 + (ap[1] - t * ab[1]) ** 2


def turn(a, b, c):
    v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (v > 0) - (v < 0)


def cross(a, b, p, q):
    boxes = all(min(a[i], b[i]) <= max(p[i], q[i]) and min(p[i], q[i]) <= max(a[i], b[i]) for i in (0, 1))
    return boxes and turn(a, b, p) * turn(a, b, q) <= 0 and turn(p, q, a) * turn(p, q, b) <= 0


def inside(p, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 <= p[1]) != (y2 <= p[1]) and p[0] < x1 + (p[1] - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def lines(seed, n=120):
    r = random.Random(seed)
    out = []
    for i in range(n):
        x, y = (50, 50) if i % 3 == 0 else (r.randint(-400, 400), r.randint(-400, 400))
        out.append((i, float(x), float(y), float(x + r.randint(-60, 60)), float(y + r.randint(-60, 60))))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(7)
    left, right = lines(1), lines(2, 60)
    points = [(i, float(r.randint(-400, 400)), float(r.randint(-400, 400))) for i in range(80)] + [(900, 55.0, 55.0)] * 3
    edge = "id int, ax double, ay double, bx double, by double"
    return {
        "left": left, "right": right, "points": points,
        "edges": spark.createDataFrame(left, edge).withColumnRenamed("id", "lid"),
        "others": spatial.other_edges(spark.createDataFrame(right, edge).withColumnRenamed("id", "rid")),
        "pts": spark.createDataFrame(points, "pid int, x double, y double"),
    }


@pytest.mark.parametrize("cell", [7, 64, 1000])
@pytest.mark.parametrize("max_pairs", [None, 20])
def test_joins_equal_brute_force(tables, cell, max_pairs):
    def dense(left, right):
        return spatial.dense_cells(left, right, cell, max_pairs) if max_pairs else None

    edges, points, others = tables["edges"], tables["pts"], tables["others"]
    found = dense(spatial.edge_box(edges, "l"), spatial.point_box(points, "r", 30.0))
    near = spatial.edges_near_points(edges, points, 30, cell, dense=found)
    want = sorted((i, p) for i, *e in tables["left"] for p, x, y in tables["points"]
                  if segment_distance2(e[:2], e[2:], (x, y)) <= 900)
    assert sorted((r.lid, r.pid) for r in near.collect()) == want
    if max_pairs and cell == 1000:
        assert found.count() > 0

    found = dense(spatial.edge_box(edges, "l"), spatial.edge_box(others, "r", ("px", "py"), ("qx", "qy")))
    met = spatial.edges_on_edges(edges, others, cell, dense=found)
    want = sorted((i, j) for i, *e in tables["left"] for j, *o in tables["right"] if cross(e[:2], e[2:], o[:2], o[2:]))
    assert sorted((r.lid, r.rid) for r in met.collect()) == want


def test_salted_cells_when_nothing_can_be_cut(spark):
    same = spark.range(300).select("id", F.lit(1.0).alias("ax"), F.lit(1.0).alias("ay"), F.lit(1.0).alias("bx"), F.lit(1.0).alias("by"))
    spots = spark.range(40).select(F.col("id").alias("pid"), F.lit(1.0).alias("x"), F.lit(1.0).alias("y"))
    found = spatial.dense_cells(spatial.edge_box(same, "l"), spatial.point_box(spots, "r"), 1000, max_pairs=100)
    assert [r["__cut"] for r in found.orderBy("__lvl").collect()] == [True] * spatial.MAX_LEVEL + [False]
    joined = spatial.edges_near_points(same, spots, 0, 1000, dense=found)
    assert joined.count() == 300 * 40
    assert joined.distinct().count() == 300 * 40


def test_wide_features_use_coarser_grids(spark, tables, monkeypatch):
    r = random.Random(11)
    boxes = [(i, x, y, x + w, y + w) for i, (x, y, w) in enumerate(
        [(r.uniform(-400, 400), r.uniform(-400, 400), r.choice([2, 30, 300, 900])) for _ in range(60)])]
    layer = spark.createDataFrame(boxes, "bid int, xmin double, ymin double, xmax double, ymax double")
    points = tables["pts"].dropDuplicates(["pid"])
    want = sorted((p, i) for p, x, y in {q[0]: q for q in tables["points"]}.values() for i, a, b, c, d in boxes if a <= x <= c and b <= y <= d)
    monkeypatch.setattr(spatial, "WIDE", 16)
    monkeypatch.setattr(spatial, "FEW", 0)
    monkeypatch.setattr(spatial, "LIGHT", 0)
    grids, _ = spatial.look(spatial.point_box(points, "l"), spatial.rect_box(layer, "r"), 4)
    assert grids == (0, 1, 2, 3)
    for max_pairs in (200_000_000, 10):
        monkeypatch.setattr(spatial, "MAX_PAIRS", max_pairs)
        found = spatial.dense_cells(spatial.point_box(points, "l"), spatial.rect_box(layer, "r"), 4, max_pairs, grids=grids)
        assert (found is None) == (max_pairs > 10)
        got = spatial.points_in_boxes(points, layer, 4, dense=found, grids=grids)
        assert sorted((r.pid, r.bid) for r in got.collect()) == want
    auto = spatial.points_in_boxes(points, layer, 4)
    assert sorted((r.pid, r.bid) for r in auto.collect()) == want


def test_polygon_with_hole(spark):
    shell = [(0, 0), (400, 0), (400, 380), (200, 150), (0, 390), (0, 0)]
    hole = [(50, 50), (150, 60), (140, 120), (50, 50)]
    rings = [[(float(x), float(y)) for x, y in ring] for ring in (shell, hole)]
    polygon = spark.createDataFrame(
        [(1, [[{"x": x, "y": y} for x, y in ring] for ring in rings])], "poly int, geom array<array<struct<x:double,y:double>>>")
    edges = spatial.ring_edges(polygon, ["poly"])
    r = random.Random(3)
    spots = [(i, r.uniform(-50, 450), r.uniform(-50, 450)) for i in range(300)]
    df = spark.createDataFrame(spots, "pid int, x double, y double")
    for cell in (20, 333):
        got = {r.pid for r in spatial.points_in_polygons(df, edges, "pid", "poly", cell, dense=None).collect()}
        assert got == {i for i, x, y in spots if inside((x, y), rings)}
    segs = [(i, [[{"x": x, "y": y}, {"x": x + r.uniform(-60, 60), "y": y + r.uniform(-60, 60)}]]) for i, x, y in spots]
    layer = spark.createDataFrame(segs, "lid int, geom array<array<struct<x:double,y:double>>>")
    met = {r.lid for r in spatial.lines_in_polygons(layer, edges, "lid", "poly", 50, dense=None).collect()}
    want = set()
    for i, ((a, b),) in segs:
        a, b = (a["x"], a["y"]), (b["x"], b["y"])
        if inside(a, rings) or any(cross(a, b, p, q) for ring in rings for p, q in zip(ring, ring[1:])):
            want.add(i)
    assert met == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        starts = spatial.starts_in_polygons(df, edges, "poly", 50, dense=None)
        text = starts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.pid for r in starts.collect()) == [i for i, x, y in spots if inside((x, y), rings)]
    assert "Exchange" not in text[:text.index("SortMergeJoin")]  # pairs of a start and a polygon are not shuffled


def test_left_join_keeps_unmatched_and_repeats(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "lid int, n string")
    right = spark.createDataFrame([(7, "x"), (8, "y")], "rid int, m string")
    pairs = spark.createDataFrame([(1, 7), (1, 8), (1, 8)], "lid int, rid int")
    rows = {(r.lid, r.m) for r in spatial.spatial_join(left, right, pairs, "lid", "rid").collect()}
    assert rows == {(1, "x"), (1, "y"), (2, None)}
    assert spatial.spatial_join(left, right, pairs, "lid", "rid", how="inner").count() == 2


def test_cells_join_without_cartesian_product(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = spatial.edges_near_points(tables["edges"], tables["pts"], 30, 64, dense=None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SortMergeJoin" in text


def test_golden_counts(spark):
    from freshet.sources import fixtures as fx

    folder = "/root/testdata/sf0.001"
    edges = geometry.edges(fx.segments(spark, folder), ["seg_id"])
    near = spatial.edges_near_points(edges, fx.crossings(spark, folder), 50, 1000).select("seg_id", "assessment_id").distinct()
    row = near.agg(F.count("*"), F.countDistinct("seg_id"), F.sum(F.col("seg_id") % 1000003)).first()
    assert tuple(row) == (3748, 2535, 2272828503)


@pytest.mark.parametrize("cell", [7, 64, 1000])
def test_lines_near_points_settles_each_pair_in_one_cell(spark, tables, cell, monkeypatch):
    ids = {i: None if i % 40 == 0 else i // 5 for i, *_ in tables["left"]}
    edges = spark.createDataFrame([(ids[i], *e) for i, *e in tables["left"]], "lid int, ax double, ay double, bx double, by double")
    spots = [(None if i % 16 == 0 else i % 60 if i < 80 else i, x, y) for i, x, y in tables["points"]]
    points = spark.createDataFrame(spots, "pid int, x double, y double")
    want = {(ids[i], p) for i, *e in tables["left"] for p, x, y in spots if segment_distance2(e[:2], e[2:], (x, y)) <= 900}
    for max_pairs in (200_000_000, 40):
        found = None if max_pairs > 40 else spatial.dense_cells(
            spatial.edge_box(edges, "l", reach=30.0), spatial.point_box(points, "r"), cell, max_pairs)
        got = [(r.lid, r.pid) for r in spatial.lines_near_points(edges, "lid", points, "pid", 30, cell, dense=found).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    single = points.where("pid >= 60 OR pid BETWEEN 20 AND 47").dropDuplicates(["pid"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = spatial.lines_near_points(edges, "lid", single, "pid", 30, cell, dense=None)
        text = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text[:text.index("SortMergeJoin")] and "Aggregate" not in text[:text.index("SortMergeJoin")]  # pairs are not shuffled
    assert text[text.index("SortMergeJoin"):].count("REPARTITION_BY_COL") == 1
    got = [(r.lid, r.pid) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == {w for w in want if w[1] in {r.pid for r in single.collect()}}


@pytest.mark.parametrize("cell, block", [(7, 2), (64, 1000), (1000, 3)])
def test_points_of_lines_are_counted_in_blocks(spark, tables, cell, block, monkeypatch):
    monkeypatch.setattr(spatial, "LINE_BLOCK", block)
    monkeypatch.setattr(spatial, "POINT_BLOCK", block)
    edges = tables["edges"].withColumn("lid", F.expr("IF(lid % 40 = 0, NULL, floor(lid / 5))"))
    points = tables["points"] + [(7, 300.0, 300.0), (None, 0.0, 0.0)]
    spots = spark.createDataFrame(points, "pid int, x double, y double")
    pairs = {(None if i % 40 == 0 else i // 5, p) for i, *e in tables["left"] for p, x, y in points if segment_distance2(e[:2], e[2:], (x, y)) <= 900}
    times = {i: sum(1 for j, _ in pairs if j == i) for i, _ in pairs}
    counts = spatial.points_per_line(edges, "lid", spots, "pid", 30, cell, dense=None)
    assert {r.lid: r.times for r in counts.collect()} == times
    known = spots.where("pid IS NOT NULL")
    first = spatial.first_near_lines(edges, "lid", known, "pid", 30, cell, dense=None)
    wanted = [(i, p) for i, p in pairs if p is not None]
    assert {r.lid: r.pid for r in first.collect()} == {i: min(p for j, p in wanted if j == i) for i, _ in wanted}
    assert "MapInArrow" in counts._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_ids_are_dealt_out_by_the_candidates_in_cells(spark):
    rows = [(None if k == 7 else k % 40, float(k % 10), 0.0, k % 10 + 1.5, 1.0) for k in range(80)]
    left = spark.createDataFrame(rows, "l int, ax double, ay double, bx double, by double")
    others = spatial.other_edges(left.withColumnRenamed("l", "r"))
    met = spatial.edges_on_edges(left, others, 5).select("l", "r")
    boxes = spatial.edge_box(left, "l"), spatial.edge_box(others, "r", ("px", "py"), ("qx", "qy"))
    candidates = spatial.candidate_pairs(*boxes, 5)
    assert met.count() <= candidates <= 4 * 80 * 80
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spatial.distinct_pairs(met, left, others, 5, task_pairs=candidates / (few + 3))
    assert dealt.rdd.getNumPartitions() in (few + 2, few + 3)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, spatial.distinct_pairs(met, left, others, 5).collect())) == sorted(map(str, met.distinct().collect()))
    assert spatial.candidate_pairs(boxes[0].limit(0), boxes[1].limit(0), 5) == 0


def odd_lines(spark, n=60):
    """Lines of one or two parts, some wide, empty or given in several rows, with ids that may be null, as (id, parts)."""
    r = random.Random(11)

    def part(width):
        x, y = r.randint(-400, 400), r.randint(-400, 400)
        return [(float(x), float(y))] + [(float(x + r.randint(-width, width)), float(y + r.randint(-width, width))) for _ in range(r.randint(1, 3))]

    rows = [(i % 47, [part(500 if i % 13 == 0 else 30) for _ in range(1 + i % 2)]) for i in range(n)]
    rows += [(None, [part(30)]), (None, [part(30)]), (200, []), (201, [[(10.0, 10.0)]]), (202, None), (203, [[], part(20)])]
    geom = [(i, None if parts is None else [[{"x": x, "y": y} for x, y in p] for p in parts]) for i, parts in rows]
    return rows, spark.createDataFrame(geom, "lid int, geom array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("cell, most", [(20, 256), (64, 256), (64, 1), (2000, 256)])
def test_lines_in_polygons_equal_brute_force(spark, monkeypatch, cell, most):
    monkeypatch.setattr(spatial, "LINE_ROWS", most)
    monkeypatch.setattr(spatial, "LINE_BLOCK", 7)
    monkeypatch.setattr(spatial, "POLYGON_BLOCK", 3)
    rows, df = odd_lines(spark)
    r, areas = random.Random(5), []
    for i in range(25):
        x, y, w = r.randint(-400, 300), r.randint(-400, 300), r.randint(20, 300)
        rings = [[(x, y), (x + w, y), (x + w, y + w), (x + w // 2, y + w // 3), (x, y + w), (x, y)]]
        rings += [[(x + 2, y + 2), (x + w // 2, y + 2), (x + w // 2, y + w // 4), (x + 2, y + 2)]] if i % 2 else []
        areas.append((i, [[(float(u), float(v)) for u, v in ring] for ring in rings]))
    shaped = [(i, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, rings in areas]
    polygons = spark.createDataFrame(shaped, "poly int, geom array<array<struct<x:double,y:double>>>")
    want = {(i, j) for i, parts in rows for j, rings in areas for p in parts or [] if p and (
        inside(p[0], rings) or any(cross(a, b, *e) for a, b in zip(p, p[1:]) for ring in rings for e in zip(ring, ring[1:])))}
    got = [tuple(p) for p in spatial.lines_in_polygons(df, spatial.ring_edges(polygons, ["poly"]), "lid", "poly", cell).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("cell, most", [(20, 256), (64, 1), (2000, 256)])
def test_lines_on_lines_equal_brute_force(spark, tables, monkeypatch, cell, most):
    monkeypatch.setattr(spatial, "LINE_ROWS", most)
    monkeypatch.setattr(spatial, "LINE_BLOCK", 7)
    monkeypatch.setattr(spatial, "POLYGON_BLOCK", 3)
    rows, df = odd_lines(spark)
    others = tables["others"].withColumn("rid", F.expr("floor(rid / 2)"))
    want = {(i, j // 2) for i, parts in rows for j, *e in tables["right"] for p in parts or []
            if any(cross(a, b, e[:2], e[2:]) for a, b in zip(p, p[1:]))}
    pairs = spatial.lines_on_lines(df, others, "lid", "rid", cell)
    got = [tuple(p) for p in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    if cell == 2000:
        assert "Aggregate" not in (text := pairs._jdf.queryExecution().optimizedPlan().toString())[:text.index("MapInArrow")]


def test_pairs_of_lines_and_polygons_are_not_shuffled(spark, tables):
    part = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    df = tables["edges"].select("lid", F.array(part).alias("geom"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rings = tables["others"].withColumn("poly_xmin", F.least("px", "qx"))
        text = spatial.lines_in_polygons(df, rings, "lid", "rid", 200)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text[:text.index("SortMergeJoin")] and "Aggregate" not in text[:text.index("SortMergeJoin")]
