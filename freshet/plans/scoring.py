"""Drought risk of streams, all sections in one job.

After sensitivities are levelled per key, a stream is one (section, key, name) group. The three overlays
(crossings, species, expert lines) share one cell join, so the lines of the whole network are filed and
shuffled once, in pieces; the starts of parts are found in them. Only per-stream aggregates of numbers and
bit sets leave it; no table of all matches is built.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from freshet.functions.nulls import UNKNOWN, coalesce_sources, row_sum0, to_int
from freshet.operators import blocks, score
from freshet.operators.chains import dissolved_lines
from freshet.operators.geometry import edges, line_pieces, reproject
from freshet.operators.groups import first_per
from freshet.operators.joins import left_join
from freshet.operators.simplify import simplify_by_section, simplify_keep
from freshet.operators.spatial import (
    edge_box, edges_on_edges, lines_in_polygons, overlay_blocks, points_per_line, polygon_texts, ray_box, rect_box, ring_edges,
    starts_in_polygons,
)
from freshet.plans.segments import keep_streams, key_levels
from freshet.sources.layers import materialise, number_rows

STREAM = ["ECOSECTION_NAME", "BLUE_LINE_KEY", "GNIS_NAME"]
CROSSING, SPECIES, EXPERT = 0, 1, 2
PIECE = 4  # edges of a line that are filed together
TASK_BYTES = 250_000_000  # of repeated texts that a task writes


def _features(crossings, species, experts):
    """The overlay layers as one table, reduced to what a stream can make use of, and the numbered entries.

    Crossings at one spot: only the first can win. Expert lines: only those with a summer flag count, and of equal edges only
    the first. Species: one entry per name, and one area per polygon and name. Entries of a kind are numbered in the order in
    which they win (fid, a, b), so a match carries a number; the number of a name is its place in bit sets of 64 names.
    """
    shape = ["px", "py", "qx", "qy"]
    first = F.struct(
        F.col("assessment_id").cast("long").alias("fid"), F.col("fish_observed").alias("a"), F.col("habitat_value").alias("b"))
    points = crossings.groupBy("x", "y").agg(F.min(first).alias("first")).select(
        F.lit(CROSSING).alias("kind"), "first.*", F.col("x").alias("px"), F.col("y").alias("py"), F.col("x").alias("qx"), F.col("y").alias("qy"))
    flags = F.struct(F.col("row_id").cast("long").alias("fid"), F.col("Summer_Sen").alias("a"), F.col("Winter_Sen").alias("b"))
    unkeyed = experts.where("BLUE_LINE_ = '0' AND Summer_Sen IS NOT NULL").withColumn("first", flags)
    lines = edges(unkeyed, ["first"]).groupBy("ax", "ay", "bx", "by").agg(F.min("first").alias("first")).select(
        F.lit(EXPERT), "first.*", "ax", "ay", "bx", "by")
    areas = species.where("SCI_NAME IS NOT NULL").select("SCI_NAME", "geom", F.col("occ_id").cast("long").alias("fid"))
    nothing = [F.lit(None).cast(t) for t in ("string", *["double"] * 4)]
    names = areas.select("SCI_NAME").distinct().select(F.lit(SPECIES), F.lit(None).cast("long"), "SCI_NAME", *nothing)
    entries = number_rows(points.union(lines).union(names), ["kind", "fid", "a", "b"], "no")
    areas = areas.groupBy("SCI_NAME", "geom").agg(F.min("fid").alias("fid"))
    rings = _named_rings(areas, entries.where(F.col("kind") == SPECIES).select(F.col("a").alias("SCI_NAME"), "no"))
    nothing = F.lit(0).cast("long").alias("bit"), F.lit(None).cast("long").alias("area")
    features = entries.where(F.col("kind") != SPECIES).select("kind", "no", *nothing, *shape)
    rings = rings.select(F.lit(SPECIES).alias("kind"), F.col("word").alias("no"), "bit", F.col("fid").alias("area"), *shape, "poly_xmin")
    return features, rings, entries.select("kind", "no", "fid", "a", "b")


def _named_rings(areas, numbers):
    """Ring edges of the areas (fid, SCI_NAME, geom) with the place of their name among the sets of 64."""
    places = {"word": F.floor(F.col("no") / 64), "bit": F.expr("shiftleft(1L, CAST(no % 64 AS INT))")}
    return ring_edges(areas.join(numbers, "SCI_NAME").withColumns(places), ["fid", "word", "bit"])


def _starts_inside(segments, rings, cell, **options):
    """(stream, word, bit) of the areas that the start of a part lies in."""
    start = [F.col("part")[0][c].alias(c) for c in "xy"]
    starts = segments.select(*STREAM, F.explode("geom").alias("part")).where(F.size("part") > 1).select(*STREAM, *start).distinct()
    return starts_in_polygons(starts, rings, ["fid", "word", "bit"], cell, **options)


def stream_overlays(segments, crossings, species, experts, radius=50, cell=1000, **options):
    """Per stream: its first crossing, number of species and first expert line; streams without any are absent.

    A line lies in a species area if it touches a ring of it or if the start of a part is inside. Lines are filed in pieces and
    ring edges in the cells that a ray can reach them from, so one join settles both, block by block. Matches are numbers: the
    smallest of a stream's crossings and expert lines wins, and its species are united as bit sets, first in the block, then
    before the shuffle; a match that several cells find changes nothing.
    """
    kind = F.col("kind")
    features, rings, entries = _features(crossings, species, experts)
    reach = F.when(kind == CROSSING, F.lit(float(radius))).otherwise(F.lit(0.0))
    features = edge_box(features, "r", ("px", "py"), ("qx", "qy"), reach).union(ray_box(rings, "r").drop("poly_xmin"))
    pieces = rect_box(line_pieces(segments, STREAM, PIECE), "l").drop("xmin", "ymin", "xmax", "ymax")
    pieces = pieces.withColumn("id", F.struct(*STREAM)).drop(*STREAM)
    met = overlay_blocks(pieces, features, ["kind", "no", "bit", "area"], cell, **options)
    schema = StructType([StructField("id", pieces.schema["id"].dataType), StructField("kind", IntegerType()),
                         *[StructField(c, LongType()) for c in ("word", "no", "bits")]])
    hits = met.mapInArrow(blocks.overlays("id", float(radius), CROSSING, SPECIES), schema).select("id.*", "kind", "word", "no", "bits")
    found = hits.groupBy(*STREAM, "kind", "word").agg(F.min("no").alias("no"), F.bit_or("bits").alias("bits"))
    streams = found.groupBy(*STREAM).agg(
        F.min(F.when(kind == CROSSING, F.col("no"))).alias("__crossing"),
        F.sum(F.when(kind == SPECIES, F.bit_count("bits")).otherwise(0)).alias("species"),
        F.min(F.when(kind == EXPERT, F.col("no"))).alias("__expert"),
    )
    for name, code in (("crossing", CROSSING), ("expert", EXPERT)):
        entry = entries.where(kind == code).select(F.col("no").alias(f"__{name}"), F.struct("fid", "a", "b").alias(name))
        streams = streams.join(entry, f"__{name}", "left")
    return streams.select(*STREAM, "crossing", "species", "expert")


def species_richness(segments, species, cell=1000, **options):
    """Number of distinct species along each stream that has any; the names of a stream are united as bit sets."""
    areas = species.where("SCI_NAME IS NOT NULL").select("SCI_NAME", "geom", F.struct("occ_id", "ENG_NAME").alias("fid"))
    rings = _named_rings(areas, number_rows(areas.select("SCI_NAME").distinct(), ["SCI_NAME"], "no"))
    touched = edges_on_edges(edges(segments, STREAM), rings.drop("fid", "poly_xmin"), cell, **options).select(*STREAM, "word", "bit")
    inside = _starts_inside(segments, rings, cell, **options).select(*STREAM, "word", "bit")
    words = touched.union(inside).groupBy(*STREAM, "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy(*STREAM).agg(F.sum(F.bit_count("bits")).alias("number_distinct_SAR"))


def keyed_experts(experts):
    """Expert flags of the first row of each stream key; '0' marks a line without key."""
    keyed = experts.where("BLUE_LINE_ <> '0'").withColumn("BLUE_LINE_KEY", to_int(F.col("BLUE_LINE_")))
    return first_per(keyed, "BLUE_LINE_KEY", "row_id").select(
        "BLUE_LINE_KEY", F.col("Summer_Sen").alias("stream_summer_sens"), F.col("Winter_Sen").alias("stream_winter_sens"))


def score_streams(segments, ecosections, crossings, species, experts, radius=50, cell=1000, **options):
    """One row per stream of each section with its attributes and drought risk.

    The expert line of a key without own flags is the first match in the order of the key's streams by name,
    then of the expert rows; the window for it holds the names of one key in one section, and streams without
    key, which take no part, stand alone. A stream is one row here, so the risk is a sum across columns.
    """
    kept = keep_streams(segments, ecosections)
    overlays = stream_overlays(kept, crossings, species, experts, radius, cell, **options)
    streams = left_join(kept.select(*STREAM).distinct(), key_levels(segments), "BLUE_LINE_KEY")
    streams = left_join(streams, overlays, STREAM)
    streams = left_join(streams, keyed_experts(experts), "BLUE_LINE_KEY")
    has_key = F.col("BLUE_LINE_KEY").isNotNull()
    match = F.struct(F.col("GNIS_NAME").isNull().alias("last"), F.col("GNIS_NAME").alias("name"), F.col("expert").alias("line"))
    key = Window.partitionBy("ECOSECTION_NAME", "BLUE_LINE_KEY", F.when(~has_key, F.col("GNIS_NAME")))
    placed = F.min(F.when(F.col("expert").isNotNull() & has_key, match)).over(key)
    streams = streams.withColumn("placed", placed).withColumns({
        "place_summer": F.col("placed.line.a"), "place_winter": F.col("placed.line.b")})
    streams = coalesce_sources(streams, {"stream_summer_sens": "place_summer", "stream_winter_sens": "place_winter"})
    known = F.nullif(F.col("species"), F.lit(0)).cast("long")
    streams = streams.select(
        *STREAM, "summer_sens", "winter_sens", "stream_summer_sens", "stream_winter_sens",
        F.coalesce("crossing.a", F.lit(UNKNOWN)).alias("fish_observed"),
        F.coalesce("crossing.b", F.lit(UNKNOWN)).alias("habitat_value"),
        known.alias("number_distinct_SAR"),
    )
    return streams.withColumn("drought_risk", row_sum0(*score.components().values()).cast("long"))


def _lines_and_areas(segments, species):
    """The streams' lines by `line` and the ring edges of the species areas by `area`."""
    rings = ring_edges(species.select(F.struct("occ_id", "SCI_NAME", "ENG_NAME").alias("area"), "geom"), ["area"])
    return segments.select(F.struct(*STREAM).alias("line"), "geom"), rings


def species_matches(segments, species, cell=1000):
    """Every (stream, occurrence) match once, as rows: the whole result, however many a stream has."""
    return lines_in_polygons(*_lines_and_areas(segments, species), "line", "area", cell).select("line.*", "area.*")


def crossing_counts(segments, crossings, radius=50, cell=1000):
    """Number of crossings along each stream that has any."""
    near = points_per_line(edges(segments, STREAM), STREAM, crossings, "assessment_id", radius, cell)
    return near.withColumn("times", F.col("times").cast("int"))


def species_lists(segments, crossings, species, radius=50, cell=1000, repeats=False):
    """Names of the species along each stream, as text.

    Each species is listed once per occurrence. The matches of a stream are its crossings times its species, so
    with `repeats` the list is written once per crossing (once when there is none). It is built once and repeated as text; the crossings and
    species of a stream are never paired. Without species the list is NA. A stream whose text would not fit
    into one cell is served by species_matches and crossing_counts.
    """
    texts = polygon_texts(*_lines_and_areas(segments, species), "line", "area", {c: c for c in ("SCI_NAME", "ENG_NAME")}, "occ_id", cell)
    texts = texts.select("line.*", "SCI_NAME", "ENG_NAME")
    streams = left_join(segments.select(*STREAM).distinct(), texts, STREAM)
    once = {c: F.coalesce(c, F.lit("NA")) for c in ("SCI_NAME", "ENG_NAME")}
    if not repeats:
        return streams.withColumns(once)
    streams = left_join(streams, crossing_counts(segments, crossings, radius, cell), STREAM)
    streams = _dealt_texts(streams.withColumns({**once, "times": F.coalesce("times", F.lit(1))}))
    return streams.withColumns({c: F.concat(F.repeat(F.concat(c, F.lit(", ")), F.col("times") - 1), c) for c in once}).drop("times")


def _dealt_texts(streams, task=TASK_BYTES):
    """Streams dealt out to tasks that write about `task` bytes of repeated texts.

    Repeated texts grow with the species of a stream times its crossings, and the longest ones come from streams that sort side by
    side. So the lists are written as they are, and the number of tasks is that of the bytes to write.
    """
    streams = materialise(streams, "species_texts")
    length = (F.octet_length("SCI_NAME") + F.octet_length("ENG_NAME") + 4).cast("double") * F.col("times")
    total = streams.agg(F.sum(length)).first()[0] or 0
    return streams.repartition(max(int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total / task)), *STREAM)


def harmonized_streams(scored):
    """Province-wide rows: streams that span sections carry their highest risk and species count."""
    return score.harmonize(scored)


DELIVERY = ["drought_risk", "BLUE_LINE_KEY", "GNIS_NAME", "number_distinct_SAR", "SCI_NAME", "ENG_NAME",
            "stream_winter_sens", "stream_summer_sens", "summer_sens", "winter_sens", "fish_observed"]


def delivery_table(scored, texts):
    """Harmonized streams with the columns of the delivered layer."""
    return left_join(harmonized_streams(scored), texts, STREAM).select(*DELIVERY)


def delivery_lines(segments, scored, share=0.025):
    """Delivered geometry: one row per stream and member line, generalised over the layer and in lon/lat, with the
    values harmonized across sections."""
    lines = segments.select("seg_id", *STREAM, "geom")
    return left_join(reproject(simplify_keep(lines, share), 3005, 4326), harmonized_streams(scored), STREAM)


def delivery_layer(segments, scored, share=0.025, again=0.10):
    """The delivered layer: streams dissolved to lines from node to node, one row per stream and part.

    Each section keeps its own share of vertices; the sections together are then thinned once more over the whole layer,
    moved to longitude and latitude, and given the values harmonized across sections.
    """
    lines = dissolved_lines(segments.select(*STREAM, "geom"), STREAM)
    lines = simplify_keep(simplify_by_section(lines, "ECOSECTION_NAME", share), again)
    return left_join(reproject(lines, 3005, 4326), harmonized_streams(scored), STREAM)
