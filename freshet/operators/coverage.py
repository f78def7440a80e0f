"""Simplification of polygon layers that keeps common borders common.

The borders of all polygons are cut into arcs, each arc is simplified once for all polygons that have it, and their rings are
put together again. A vertex is a node where other than two edges of the whole layer meet. As the borders of a polygon close,
a polygon that has one of the two edges at any other vertex has the other one as well, so an arc belongs as a whole to the
polygons that have its first edge; no sets of neighbours are gathered or compared.
"""

from functools import partial

from pyspark.sql import functions as F

from freshet.operators.chains import chain_parts, part_lines
from freshet.operators.geometry import EDGE, canonical, edges
from freshet.operators.joins import heavy_keys, left_join, spread_join
from freshet.operators.noding import node_pieces
from freshet.operators.simplify import simplify_keep
from freshet.sources.layers import materialise


def _odd(edge_table, key):
    """Edges that a polygon has an odd number of times; what it passes there and back is no border."""
    real = canonical(edge_table).where("ax <> bx OR ay <> by")
    return real.groupBy(key, *EDGE).agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")


def polygon_borders(df, key, cell=None):
    """(key, edge) of all polygons; with a `cell` width, borders are cut wherever those of any two polygons meet."""
    borders = materialise(_odd(edges(df, [key]), key), "borders")
    if cell is None:
        return borders
    pieces = node_pieces(borders.select(*EDGE).distinct(), [], cell)
    whole = pieces.select(*[F.col(f"whole.{c}").alias(f"__{c}") for c in EDGE], *EDGE)
    cut = borders.withColumnsRenamed({c: f"__{c}" for c in EDGE}).join(whole, [f"__{c}" for c in EDGE])
    return materialise(_odd(cut.select(key, *EDGE), key), "borders")


def border_arcs(borders, key):
    """Arcs of a layer as lines (part, n_edges, geom), and which polygon has which arc (key, part)."""
    parts = materialise(chain_parts(borders.select(*EDGE).distinct(), []), "arcs")
    first = canonical(parts.where("place = 0").select("part", *EDGE))
    return part_lines(parts, []), borders.join(first, EDGE).select(key, "part")


def simplify_coverage(df, key, thin=partial(simplify_keep, share=0.05), cell=None):
    """Polygons with simplified borders; neighbours have the same vertices on what they share.

    `key` tells polygons apart, and `thin` simplifies a line layer, by default to a share of the inner vertices of all arcs.
    Nodes always stay. Borders must have the same vertices on both sides; where they have not, `cell` (a grid width) cuts
    them first. `geom` holds the rings of a polygon from their smallest vertices, those of holes and of several areas alike,
    to be read by the even-odd rule; a ring may touch itself or another one in a vertex, but does not cross it there. A polygon whose borders fall together,
    and one without geometry, has an empty `geom`. Arcs that come to cross by being simplified are not repaired. An arc with
    a million owners is dealt out over several tasks.
    """
    borders = polygon_borders(df, key, cell)
    arcs, owners = border_arcs(borders, key)
    owners = materialise(owners, "arc_owners")
    thinned = thin(arcs).select("part", "geom")
    heavy = heavy_keys(owners.groupBy("part").agg(F.count("*").alias("n")), "part")
    held = spread_join(owners, thinned, "part", heavy)
    rings = part_lines(chain_parts(_odd(edges(held, [key]), key), key, through=True), key)
    shapes = rings.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("part", F.col("geom")[0].alias("ring")))).alias("rings"))
    shapes = shapes.select(key, F.col("rings.ring").alias("__geom"))
    none = F.array().cast(df.schema["geom"].dataType)
    joined = left_join(df, shapes, key)
    return joined.withColumn("geom", F.coalesce("__geom", none)).select(*df.columns)
