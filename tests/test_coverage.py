import random
from collections import Counter, defaultdict
from functools import partial

import numpy as np
from pyspark.sql import functions as F

from freshet.operators import chains, coverage, simplify
from tests.test_chains import table, walk

POINT = "array<array<struct<x:double,y:double>>>"


def layer(spark, shapes):
    """`shapes`: id -> rings (None: no geometry)."""
    rows = [(k, f"n{k}", rings and [[{"x": float(a), "y": float(b)} for a, b in r] for r in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(rows, f"id long, name string, geom {POINT}")


def rings_of(df):
    return {r["id"]: [[(v["x"], v["y"]) for v in ring] for ring in r["geom"]] for r in df.collect()}


def edge_set(rings):
    pairs = Counter(tuple(sorted(e)) for r in rings for e in zip(r, r[1:], strict=False))
    return {e for e, n in pairs.items() if n % 2 and e[0] != e[1]}


def area(rings):
    """Even-odd area of rings that do not cross: the outer ring less its holes."""
    found = sorted((abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:], strict=False))) / 2 for r in rings), reverse=True)
    return found[0] - sum(found[1:])


def tiles(pick, wide, high, m):
    """A grid of tiles whose sides wind, as closed rings of 4 * m edges."""
    shift = {}

    def at(gx, gy):
        if (gx, gy) not in shift:
            corner = gx % m == 0 and gy % m == 0
            shift[gx, gy] = (0, 0) if corner else (0, pick.randint(-30, 30)) if gy % m == 0 else (pick.randint(-30, 30), 0)
        return gx * 100 + shift[gx, gy][0], gy * 100 + shift[gx, gy][1]

    out = {}
    for i in range(wide):
        for j in range(high):
            x, y = i * m, j * m
            path = [(x + t, y) for t in range(m)] + [(x + m, y + t) for t in range(m)] + [(x + m - t, y + m) for t in range(m)] + [(x, y + m - t) for t in range(m)]
            start = pick.randrange(len(path))
            path = path[start:] + path[:start]
            out[i * high + j] = [[at(*v) for v in [*path, path[0]][::pick.choice([1, -1])]]]
    return out


def by_walking(shapes, share):
    """Edges of every polygon after its arcs, found by walking, were simplified."""
    own = {k: edge_set(rings) for k, rings in shapes.items()}
    arcs = walk(set().union(*own.values()))
    areas = [simplify._effective_areas(*(np.array(c, float) for c in zip(*p, strict=True))) for p in arcs]
    inner = sorted((a for one in areas for a in one if a < np.inf), reverse=True)
    k = int(round(share * len(inner)))
    bound = inner[k - 1] if k else np.inf
    out = defaultdict(Counter)
    for path, one in zip(arcs, areas, strict=True):
        kept = [v for v, a in zip(path, one, strict=True) if a >= bound]
        for key, mine in own.items():
            if tuple(sorted(path[:2])) in mine:
                out[key] += Counter(tuple(sorted(e)) for e in zip(kept, kept[1:], strict=False))
    return {key: {e for e, n in out[key].items() if n % 2 and e[0] != e[1]} for key in own}


def test_neighbours_keep_a_common_border(spark):
    shapes = tiles(random.Random(3), 4, 3, 8)
    del shapes[4], shapes[7]
    df = layer(spark, shapes)
    found = coverage.simplify_coverage(df, "id", partial(simplify.simplify_keep, share=0.2))
    assert found.columns == df.columns and found.count() == len(shapes)
    got = rings_of(found)
    assert {k: edge_set(r) for k, r in got.items()} == by_walking(shapes, 0.2)
    assert all(len(r) == 1 and r[0][0] == r[0][-1] == min(r[0]) for r in got.values())
    assert sum(len(r[0]) for r in got.values()) < sum(len(r[0]) for r in shapes.values()) / 2
    # No gap and no overlap: the areas add up to that of the outline, whose edges have one owner each.
    owners = Counter(e for r in got.values() for e in edge_set(r))
    assert set(owners.values()) == {1, 2}
    outline = [p for p in walk({e for e, n in owners.items() if n == 1})]
    assert area(outline) == sum(area(r) for r in got.values())


def test_random_areas_with_many_owners_equal_walking(spark):
    pick = random.Random(5)
    for _ in range(2):
        shapes = {}
        for k in range(6):
            cells = {(pick.randint(0, 3), pick.randint(0, 3)) for _ in range(pick.randint(1, 8))}
            sides = Counter(tuple(sorted(e)) for x, y in cells for e in (((x, y), (x + 1, y)), ((x + 1, y), (x + 1, y + 1)), ((x, y + 1), (x + 1, y + 1)), ((x, y), (x, y + 1))))
            shapes[k] = [list(map(lambda v: (v[0] * 7.0, v[1] * 5.0), e)) for e, n in sides.items() if n % 2]
        found = rings_of(coverage.simplify_coverage(layer(spark, shapes), "id", partial(simplify.simplify_keep, share=0.5)))
        assert {k: edge_set(r) for k, r in found.items()} == by_walking(shapes, 0.5)
        for rings in found.values():
            assert all(r[0] == r[-1] and len(r) > 3 for r in rings)


def test_borders_with_different_vertices_are_cut_first(spark):
    left = {1: [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]], 2: [[(0, 10), (10, 10), (10, 20), (0, 20), (0, 10)]]}
    shapes = left | {3: [[(10, 0), (20, 0), (20, 20), (10, 20), (10, 0)]]}
    got = rings_of(coverage.simplify_coverage(layer(spark, shapes), "id", lambda lines: lines, cell=7))
    assert (10.0, 10.0) in got[3][0] and ((10.0, 0.0), (10.0, 10.0)) in edge_set(got[3])
    assert edge_set(got[1]) & edge_set(got[3]) == {((10.0, 0.0), (10.0, 10.0))}
    assert [area(got[k]) for k in (1, 2, 3)] == [100, 100, 200]


def test_enclaves_pinches_collapsed_and_missing_shapes(spark):
    hole = [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]
    shapes = {
        1: [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], hole],
        2: [hole[::-1]],
        3: [[(20, 0), (22, 2), (24, 0), (24, 4), (22, 2), (20, 4), (20, 0)]],
        4: None,
        5: [],
        6: [[(30, 0), (30, 0), (30, 0)], [(40, 0), (41, 0), (40, 0)]],
    }
    got = rings_of(coverage.simplify_coverage(layer(spark, shapes), "id", lambda lines: lines))
    assert sorted(len(r) for r in got[1]) == [5, 5] and edge_set(got[1]) & edge_set(got[2]) == edge_set([hole])
    assert edge_set(got[3]) == edge_set(shapes[3]) and all(r[0] == r[-1] for r in got[3])  # touching itself in (22, 2)
    assert got[4] == got[5] == got[6] == []
    none = rings_of(coverage.simplify_coverage(layer(spark, shapes), "id", partial(simplify.simplify_keep, share=0.0)))
    assert none[1] == none[2] == []  # rings without nodes fall together; the two rings of 3 are arcs from node to itself
    assert none[3] == []


def test_empty_layer_and_null_key(spark):
    assert coverage.simplify_coverage(layer(spark, {}), "id").count() == 0
    square = [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]
    df = layer(spark, {None: square, 7: square})
    got = rings_of(coverage.simplify_coverage(df, "id", lambda lines: lines))
    assert edge_set(got[None]) == edge_set(got[7]) == edge_set(square)


def test_lines_through_nodes_are_rings(spark):
    pick, rows = random.Random(8), []
    for key in (None, "a", "b"):
        cells = {(pick.randint(0, 4), pick.randint(0, 4)) for _ in range(11)}
        sides = Counter(tuple(sorted(e)) for x, y in cells for e in (((x, y), (x + 1, y)), ((x + 1, y), (x + 1, y + 1)), ((x, y + 1), (x + 1, y + 1)), ((x, y), (x, y + 1))))
        rows += [(key, *map(float, (*a, *b))) for (a, b), n in sides.items() if n % 2]
    df = table(spark, rows)
    lines = chains.part_lines(chains.chain_parts(df, "key", through=True), "key").collect()
    seen = Counter()
    for r in lines:
        path = [(v["x"], v["y"]) for v in r["geom"][0]]
        assert path[0] == path[-1]
        seen.update((r["key"], tuple(sorted(e))) for e in zip(path, path[1:], strict=False))
    assert seen == Counter((r[0], tuple(sorted((r[1:3], r[3:5])))) for r in rows)
    assert df.agg(F.count("*")).first()[0] == len(seen)
