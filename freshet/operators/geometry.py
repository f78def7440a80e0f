"""Line layers: `geom` is an array of parts, each an array of vertices {x, y}.

Work on whole layers runs on the edge table (one row per two-point edge), so no feature or group has to
fit into one cell or one task.
"""

from pyspark.sql import functions as F

from freshet.operators.joins import _as_list

EDGE = ["ax", "ay", "bx", "by"]


def line_geom(*vertices):
    """One-part line from pairs of coordinate columns."""
    points = [F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in vertices]
    return F.array(F.array(*points))


def points_from(df, x, y):
    """Point layer columns x and y from coordinate columns."""
    return df.withColumn("x", F.col(x).cast("double")).withColumn("y", F.col(y).cast("double"))


def drop_z(df):
    """Keep only x and y of every vertex."""
    def flat(vertex):
        return F.struct(vertex["x"].alias("x"), vertex["y"].alias("y"))

    return df.withColumn("geom", F.transform("geom", lambda part: F.transform(part, flat)))


def _parts(df, keep):
    """The parts with an edge, one a row.

    The outer explode keeps Spark from testing the size of `geom` below the exchange that deals out a small file: a geometry
    that is computed from columns would be computed for all rows in the task that scans the file.
    """
    return df.select(*_as_list(keep), F.explode_outer("geom").alias("part")).where(F.size("part") > 1)


def edges(df, keep):
    """Edge table of a line layer: the kept columns plus the two end points of every edge."""
    parts = _parts(df, keep)
    pairs = parts.select(
        *_as_list(keep),
        F.explode(F.expr("arrays_zip(slice(part, 1, size(part) - 1), slice(part, 2, size(part) - 1))")).alias("e"),
    )
    return pairs.select(
        *_as_list(keep),
        F.col("e")["0"]["x"].alias("ax"), F.col("e")["0"]["y"].alias("ay"),
        F.col("e")["1"]["x"].alias("bx"), F.col("e")["1"]["y"].alias("by"),
    )


def line_pieces(df, keep, length):
    """Pieces of at most `length` edges of every part: the kept columns, `first` (the piece has the part's start), the
    coordinates as one array x, y, x, y, ... in `flat`, and the box."""
    parts = _parts(df, keep)
    firsts = F.sequence(F.lit(0), F.floor((F.size("part") - 2) / length).cast("int"))
    runs = parts.select(*_as_list(keep), "part", F.explode(firsts).alias("no"))
    runs = runs.select(*_as_list(keep), (F.col("no") == 0).alias("first"), F.slice("part", F.col("no") * length + 1, F.lit(length + 1)).alias("run"))
    xs, ys = F.col("run.x"), F.col("run.y")
    flat = F.flatten(F.transform("run", lambda v: F.array(v["x"], v["y"])))
    return runs.select(*_as_list(keep), "first", flat.alias("flat"), F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                       F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def part_edges(df, keep):
    """Edge table with `part_no` and `place`, the number of the part and of the edge in it, from 0."""
    parts = df.select(*_as_list(keep), F.posexplode_outer("geom").alias("part_no", "part")).where(F.size("part") > 1)
    pairs = parts.select(
        *_as_list(keep), "part_no",
        F.posexplode(F.expr("arrays_zip(slice(part, 1, size(part) - 1), slice(part, 2, size(part) - 1))")).alias("place", "e"),
    )
    return pairs.select(
        *_as_list(keep), "part_no", "place",
        F.col("e")["0"]["x"].alias("ax"), F.col("e")["0"]["y"].alias("ay"),
        F.col("e")["1"]["x"].alias("bx"), F.col("e")["1"]["y"].alias("by"),
    )


def edge_length():
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    return F.sqrt(dx * dx + dy * dy)


def canonical(edge_table):
    """Give each edge one direction, so that equal edges compare equal."""
    swap = F.struct("ax", "ay") > F.struct("bx", "by")
    a, b = F.struct("ax", "ay"), F.struct("bx", "by")
    low = F.when(swap, b.cast("struct<x:double,y:double>")).otherwise(a.cast("struct<x:double,y:double>"))
    high = F.when(swap, a.cast("struct<x:double,y:double>")).otherwise(b.cast("struct<x:double,y:double>"))
    rest = [c for c in edge_table.columns if c not in EDGE]
    flat = edge_table.select(*rest, low.alias("lo"), high.alias("hi"))
    return flat.select(
        *rest, F.col("lo.x").alias("ax"), F.col("lo.y").alias("ay"), F.col("hi.x").alias("bx"), F.col("hi.y").alias("by")
    )


def with_length(df, name="length_m"):
    """Length of each feature in map units."""
    def part_length(part):
        shifted = F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0)))
        steps = F.zip_with(
            F.slice(part, F.lit(1), F.greatest(F.size(part) - 1, F.lit(0))), shifted,
            lambda a, b: F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])),
        )
        return F.aggregate(steps, F.lit(0.0), lambda total, s: total + s)

    lengths = F.transform("geom", part_length)
    return df.withColumn(name, F.aggregate(lengths, F.lit(0.0), lambda total, s: total + s))


def dissolve(df, keys):
    """Union of the lines of each key, as the table of its distinct edges.

    A key may own any number of rows; its geometry stays a set of edge rows rather than one nested cell.
    """
    return canonical(edges(df, keys)).distinct()


def dissolved_size(edge_table, keys):
    """Edge count and length per key of a dissolved layer."""
    return edge_table.groupBy(*_as_list(keys)).agg(
        F.count("*").alias("n_edges"), F.sum(edge_length()).alias("length_m")
    )


def geom_hash(df, name="geom_hash"):
    """Two hashes of each feature's distinct edges, free of direction and order."""
    def part_edges(part):
        n = F.greatest(F.size(part) - 1, F.lit(0))
        return F.zip_with(
            F.slice(part, F.lit(1), n), F.slice(part, F.lit(2), n),
            lambda a, b: F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")),
        )

    flat = F.array_sort(F.array_distinct(F.flatten(F.transform("geom", part_edges))))
    return df.withColumn(name, F.struct(F.xxhash64(flat).alias("h1"), F.xxhash64(F.lit(1), flat).alias("h2")))


def edge_fingerprint(edge_table, keys):
    """Order-free fingerprint of each key's edges: edge count and two sums of 64-bit hashes, so that repeats count."""
    h1, h2 = (F.xxhash64(*seed, *EDGE).cast("decimal(20,0)") for seed in ([], [F.lit(1)]))
    return edge_table.groupBy(*_as_list(keys)).agg(
        F.count("*").alias("n_edges"), F.sum(h1).alias("h1"), F.sum(h2).alias("h2")
    )


def boundary_points(df, keep):
    """Boundary of each feature: part ends that occur an odd number of times, with their order.

    Closed lines have none.
    """
    ends = df.select(*_as_list(keep), F.posexplode_outer("geom").alias("part_no", "part")).where(F.size("part") > 1)
    ends = ends.select(
        *_as_list(keep), "part_no",
        F.posexplode(F.array(F.element_at("part", 1), F.element_at("part", -1))).alias("side", "p"),
    )
    ends = ends.groupBy(*_as_list(keep), F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(
        F.count("*").alias("degree"), F.min(F.col("part_no") * 2 + F.col("side")).alias("end_no")
    )
    return ends.where("degree % 2 = 1").drop("degree")


def reproject(df, source, target):
    """Move a point layer (x, y) or a line layer (geom) between the provincial grid and longitude/latitude."""
    from freshet.functions.geo import albers_to_lonlat, lonlat_to_albers

    moves = {(3005, 4326): albers_to_lonlat, (4326, 3005): lonlat_to_albers}
    if source == target:
        return df
    move = moves[(source, target)]
    if "geom" in df.columns:
        def vertex(v):
            x, y = move(v["x"], v["y"])
            return F.struct(x.alias("x"), y.alias("y"))

        return df.withColumn("geom", F.transform("geom", lambda part: F.transform(part, vertex)))
    x, y = move(F.col("x"), F.col("y"))
    return df.withColumns({"x": x, "y": y})
