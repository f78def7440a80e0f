"""Exact equality of geometries: hashes only say which edge sets are worth comparing."""

from pyspark.sql import functions as F

from freshet.operators.geometry import EDGE
from freshet.sources.layers import materialise


def _fingerprint(rows, key):
    """Edge count and two sums of 64-bit hashes per key, free of order; repeats of an edge count."""
    h1, h2 = (F.sum(F.xxhash64(*seed, *EDGE, "times").cast("decimal(20,0)")) for seed in ([], [F.lit(1)]))
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.struct(F.sum("times").alias("n_edges"), h1.alias("h1"), h2.alias("h2")).alias("print"))


def geometry_classes(edge_table, key, fingerprint=_fingerprint):
    """(key, class): the smallest key whose edges are the same, whatever their order; edges have one direction.

    Keys with equal fingerprints are compared edge by edge with the smallest key among them, never with each other, so the
    work is linear. Keys that differ from it in spite of an equal fingerprint are compared with the smallest key among
    themselves in another round; with 64-bit hashes there is one round. A null key is left out.
    """
    edges = edge_table.where(F.col(key).isNotNull())
    rows = materialise(edges.groupBy(key, *EDGE).agg(F.count("*").alias("times")), "edge_sets")
    todo = materialise(fingerprint(rows, key), "fingerprints")
    found = None
    while True:
        first = todo.groupBy("print").agg(F.min(key).alias("class"))
        members = todo.join(first, "print")
        others = members.where(F.col(key) != F.col("class"))
        theirs = rows.select(F.col(key).alias("class"), *EDGE, "times")
        shared = rows.join(others.select(key, "class"), key).join(theirs, ["class", *EDGE, "times"]).groupBy(key).agg(F.count("*").alias("shared"))
        sizes = members.select(F.col(key).alias("class"), F.col("n").alias("class_n")).where(F.col("class").isNotNull())
        judged = members.join(shared, key, "left").join(sizes, "class")
        same = (F.col(key) == F.col("class")) | ((F.col("n") == F.col("class_n")) & F.col("shared").eqNullSafe(F.col("n")))
        judged = materialise(judged.select(key, "print", "n", "class", same.alias("same")), "geometry_classes")
        equal = judged.where("same").select(key, "class")
        found = equal if found is None else found.unionByName(equal)
        todo = judged.where("NOT same").select(key, "print", "n")
        if todo.isEmpty():
            return found
