import random

from pyspark.sql import functions as F

from freshet.operators.equality import geometry_classes
from freshet.operators.geometry import canonical

SCHEMA = "id long, ax double, ay double, bx double, by double"


def weak(rows, key):
    """A fingerprint by which all geometries of one size look equal."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.struct(F.sum("times").alias("n_edges")).alias("print"))


def expected(rows):
    shapes = {}
    for i, *edge in rows:
        if i is not None:
            a, b = tuple(edge[:2]), tuple(edge[2:])
            shapes.setdefault(i, []).append((min(a, b), max(a, b)))
    first = {}
    for i in sorted(shapes):
        first.setdefault(tuple(sorted(shapes[i])), i)
    return {i: first[tuple(sorted(s))] for i, s in shapes.items()}


def test_classes_are_exact_whatever_the_hash(spark):
    pick = random.Random(3)
    rows = [(i, *(float(pick.randint(0, 1)) for _ in range(4))) for i in range(120) for _ in range(pick.randint(1, 3))]
    rows += [(None, 0.0, 0.0, 1.0, 1.0), (500, 0.0, 0.0, 1.0, 1.0), (501, 1.0, 1.0, 0.0, 0.0), (502, 0.0, 0.0, 1.0, 1.0), (502, 0.0, 0.0, 1.0, 1.0)]
    df = canonical(spark.createDataFrame(rows, SCHEMA))
    for options in ({}, {"fingerprint": weak}):
        assert {r["id"]: r["class"] for r in geometry_classes(df, "id", **options).collect()} == expected(rows)


def test_empty_table(spark):
    assert geometry_classes(spark.createDataFrame([], SCHEMA), "id").count() == 0
