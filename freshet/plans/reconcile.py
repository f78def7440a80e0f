"""Replace hand-digitized lines by longer catalogue lines of the same stream.

Geometry stays in edge tables: the hand layer gives its attributes and lengths, the catalogue its dissolved
edges per (key, name).
"""

from pyspark.sql import functions as F

from freshet.functions.nulls import paste
from freshet.operators.equality import geometry_classes
from freshet.operators.geometry import EDGE, canonical, dissolve, dissolved_size, edges, with_length
from freshet.operators.groups import column_dupes, text_list
from freshet.operators.joins import heavy_keys, inner_join, left_join, semi_join, spread_join
from freshet.operators.spatial import edges_on_edges, other_edges
from freshet.sources.layers import materialise

STREAM = ["BLUE_LINE_KEY", "GNIS_NAME"]
ALL_SEVEN = ["BLUE_LINE_", "GNIS_NAME", "StreamName", "EcoProvinc", "Ecosection", "Summer_Sen", "Winter_Sen"]


def merge_hand_lines(hand):
    """Hand-digitized rows dissolved on their seven attributes, as distinct edges."""
    return dissolve(hand, ALL_SEVEN)


def touching_longer(catalogue_lines, hand, cell=1000, factor=1.5):
    """Catalogue streams that touch a hand line of the same name and are more than `factor` times as long.

    The catalogue names are first reduced to those in the hand layer; the name is then part of the match.
    """
    lengths = dissolved_size(catalogue_lines, STREAM).select(*STREAM, F.col("length_m").alias("length_from_auto_search"))
    measured = with_length(hand)
    named = semi_join(catalogue_lines, hand.select(F.col("StreamName").alias("GNIS_NAME")).distinct(), "GNIS_NAME")
    hand_edges = other_edges(edges(measured, ["StreamName", "length_m"]))
    met = edges_on_edges(named, hand_edges, cell).where("GNIS_NAME = StreamName")
    met = met.select(*STREAM, "length_m").distinct()
    longer = left_join(met, lengths, STREAM).where(F.col("length_from_auto_search") > factor * F.col("length_m"))
    return longer.select(*STREAM).distinct()


def replaceable_keys(hand):
    """Row keys (stream key and name as one text) that may take a new geometry: one row, or rows whose summer
    and winter flags all agree."""
    keyed = hand.withColumn("uniqID", paste(F.col("BLUE_LINE_"), F.col("StreamName")))
    flags = keyed.groupBy("uniqID").agg(
        F.count("*").alias("n"),
        *[F.min(F.coalesce(c, F.lit("NA"))).alias(f"lo_{c}") for c in ("Summer_Sen", "Winter_Sen")],
        *[F.max(F.coalesce(c, F.lit("NA"))).alias(f"hi_{c}") for c in ("Summer_Sen", "Winter_Sen")],
    )
    same = "n = 1 OR (lo_Summer_Sen = hi_Summer_Sen AND lo_Winter_Sen = hi_Winter_Sen)"
    return flags.where(same).select("uniqID", "n")


def replace_geometry(hand, updates):
    """Mark each hand row with the catalogue stream whose geometry it takes; the last update of a key wins.

    `updates` has BLUE_LINE_KEY, GNIS_NAME and optionally `ord`. Rows that keep their own line have nulls.
    """
    order = F.struct(F.col("ord") if "ord" in updates.columns else F.lit(0).alias("ord"), *STREAM)
    last = updates.groupBy(paste(F.col("BLUE_LINE_KEY"), F.col("GNIS_NAME")).alias("uniqID")).agg(F.max(order).alias("u"))
    last = inner_join(last, replaceable_keys(hand), "uniqID").select(
        "uniqID", "n", F.col("u.BLUE_LINE_KEY").alias("new_key"), F.col("u.GNIS_NAME").alias("new_name"))
    keyed = hand.withColumn("uniqID", paste(F.col("BLUE_LINE_"), F.col("StreamName")))
    heavy = heavy_keys(last, "uniqID")
    return spread_join(keyed, last.drop("n"), "uniqID", heavy)


def _edge_sets(hand_marked, catalogue_lines):
    """Edges of the lines that hand rows keep and of the catalogue streams, by `__g`."""
    own = hand_marked.where("new_name IS NULL").withColumn("__g", paste(F.lit("row "), F.col("row_id")))
    return edges(own, ["__g"]).unionByName(catalogue_lines.select(F.to_json(F.struct(*STREAM)).alias("__g"), *EDGE))


def _geometry_ids(hand_marked, catalogue_lines):
    """Size of the geometry each hand row ends up with, and geometry_id, which is equal where all edges are equal."""
    own = hand_marked.where("new_name IS NULL").withColumn("__g", paste(F.lit("row "), F.col("row_id")))
    every = _edge_sets(hand_marked, catalogue_lines)
    facts = left_join(geometry_classes(every, "__g").withColumnRenamed("class", "geometry_id"), dissolved_size(every, "__g"), "__g")
    taken = hand_marked.where("new_name IS NOT NULL").withColumn(
        "__g", F.to_json(F.struct(F.col("new_key").alias(STREAM[0]), F.col("new_name").alias(STREAM[1]))))
    return left_join(own.unionByName(taken), facts, "__g").drop("__g", "geom")


def _with_overrides(rows, overrides, edge_sets):
    """Rows of listed keys take the given section list and the union of their lines; repeated rows are removed."""
    listed = overrides.where("Ecosection IS NOT NULL").select("BLUE_LINE_", F.col("Ecosection").alias("__section"))
    joined = materialise(left_join(rows, listed, "BLUE_LINE_"), "overridden")
    chosen = joined.where("__section IS NOT NULL")
    members = chosen.select("BLUE_LINE_", F.col("geometry_id").alias("__g")).distinct()
    sizes = dissolved_size(inner_join(canonical(edge_sets), members, "__g").select("BLUE_LINE_", *EDGE).distinct(), "BLUE_LINE_")
    united = left_join(chosen.drop("n_edges", "length_m"), sizes, "BLUE_LINE_").withColumns({
        "Ecosection": F.col("__section"), "replaced": F.lit(True),
        "geometry_id": paste(F.lit("united "), F.col("BLUE_LINE_"))})
    return joined.where("__section IS NULL").select(rows.columns).unionByName(united.select(rows.columns).distinct())


def reconcile(hand, catalogue_lines, cell=1000, unkeyed="0", overrides=None):
    """Hand layer after replacement: geometry size, merged section lists, repeated rows removed.

    Rows are flagged when geometry, both flags and key each occurred in an earlier row; all rows of a flagged
    key get the key's sections as one list. Rows with the `unkeyed` mark are different streams and are never
    merged (None merges them like any key). Repeated rows are removed before the lists are attached, so a
    list is written once per remaining row.

    `overrides` (BLUE_LINE_ and Ecosection, each key once) are manual corrections made last: all rows of a listed key share
    the union of the lines they then have and the given section list; they count as replaced.

    The streams that replace lines and the replaced rows are used many times and therefore written to the shared folder; `catalogue_lines`
    should be a written table as well, as lookup_lines gives it.
    """
    # Both are read several times; the meetings of lines are the dearest step.
    updates = materialise(touching_longer(catalogue_lines, hand, cell), "updates")
    replaced_rows = materialise(replace_geometry(hand, updates), "replaced_rows")
    rows = materialise(_geometry_ids(replaced_rows, catalogue_lines), "hand_rows")
    flagged = column_dupes(rows, ["geometry_id", "Summer_Sen", "Winter_Sen", "BLUE_LINE_"], "row_id").where("is_dup")
    if unkeyed is not None:
        flagged = flagged.where(F.col("BLUE_LINE_") != unkeyed)
    merged_keys = materialise(flagged.select("BLUE_LINE_").distinct(), "merged_keys")
    members = semi_join(rows, merged_keys, "BLUE_LINE_")
    sizes = members.groupBy("BLUE_LINE_").agg(F.count("*").alias("n"))
    # Unkeyed rows, often the most frequent value, can match nothing and take no part in the joins on the key.
    loose = F.lit(False) if unkeyed is None else F.col("BLUE_LINE_").eqNullSafe(unkeyed)
    marked = spread_join(rows.where(~loose), merged_keys.withColumn("merged", F.lit(True)), "BLUE_LINE_", heavy_keys(sizes, "BLUE_LINE_"))
    marked = marked.unionByName(rows.where(loose).withColumn("merged", F.lit(None).cast("boolean")))
    own_section = F.when(F.col("merged").isNull(), F.col("Ecosection"))
    replaced = F.col("new_name").isNotNull().alias("replaced")
    distinct = marked.withColumn("Ecosection", own_section).select(
        *ALL_SEVEN, "merged", replaced, "n_edges", "length_m", "geometry_id").distinct()
    lists = text_list(members, "BLUE_LINE_", {"Ecosections": "Ecosection"}, "row_id")
    listed = left_join(distinct.where("merged"), lists, "BLUE_LINE_").withColumn("Ecosection", F.col("Ecosections")).drop("Ecosections")
    out = listed.unionByName(distinct.where("merged IS NULL")).drop("merged")
    return out if overrides is None else _with_overrides(out, overrides, _edge_sets(replaced_rows, catalogue_lines))


def apply_overrides(hand, overrides):
    """Manual corrections: all rows of a listed key share the union of their lines and the given section list.

    `overrides` has BLUE_LINE_ and Ecosection. Returns the corrected attribute rows without repeats and the
    edge table of the corrected keys.
    """
    fixed = overrides.select("BLUE_LINE_", F.col("Ecosection").alias("__section"))
    joined = left_join(hand, fixed, "BLUE_LINE_")
    rows = joined.withColumn("Ecosection", F.coalesce("__section", "Ecosection"))
    united = dissolve(joined.where("__section IS NOT NULL").select("BLUE_LINE_", "geom"), "BLUE_LINE_")
    one_geometry = F.when(F.col("__section").isNull(), F.col("row_id"))
    attributes = rows.withColumn("own_line", one_geometry).select(*ALL_SEVEN, "own_line").distinct()
    return attributes, united
