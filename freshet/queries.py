"""Registered queries: one per operator or job, each over whole tables of a test-data folder."""

from functools import partial

from pyspark.sql import functions as F

from freshet.functions.nulls import clean_numeric, fill_missing, flag_to_int, not_in, to_int
from freshet.functions.ordinal import SENSITIVITY, encode
from freshet.functions.text import snake_columns
from freshet.operators import chains, coverage, geometry, groups, joins, naming, noding, scales, score, simplify, spatial
from freshet.plans import downloads, experts, explorer, lookup, reconcile, scoring, segments, species, stations, variant
from freshet.session import shared_dir
from freshet.sources import fixtures as fx
from freshet.sources import layers, sheets

K3 = scoring.STREAM
LABELS = {"none": "not sensitive", "some": "one season", "all": "sensitive"}
REGION = "ASIA"


def _mm(col):
    return F.round(F.col(col) * 1000).cast("long").alias("length_mm")


def _ints(*cols):
    return [F.col(c).cast("long").alias(c) for c in cols]


# --- segments ---------------------------------------------------------------------------------------------

def seg_max_sensitivity(s, d):
    return segments.spread_sensitivity(fx.segments(s, d)).select("seg_id", "BLUE_LINE_KEY", "summer_sens", "winter_sens")


def _kept(s, d):
    return segments.keep_streams(fx.segments(s, d), fx.ecosections(s, d))


def seg_filter(s, d):
    return _kept(s, d).select("seg_id", "ECOSECTION_NAME", "STREAM_ORDER", "FEATURE_SOURCE")


def segment_preparation(s, d):
    prepared = segments.prepare_segments(fx.segments(s, d), fx.ecosections(s, d))
    return prepared.select("seg_id", *K3, "summer_sens", "winter_sens")


def source_not_in_list(s, d):
    df = fx.segments(s, d)
    return df.where(not_in(F.col("FEATURE_SOURCE"), segments.DROPPED_SOURCES)).select("seg_id", "FEATURE_SOURCE")


def ordinal_encode(s, d):
    df = fx.segments(s, d)
    return df.select("seg_id", encode(F.col("summer_sens"), SENSITIVITY).alias("summer_code"),
                     encode(F.col("winter_sens"), SENSITIVITY, base=1).alias("winter_code"))


# --- joins, counts, names ---------------------------------------------------------------------------------

def count_sorted(s, d):
    return groups.count_by(fx.segments(s, d), ["BLUE_LINE_KEY", "GNIS_NAME"])


def add_count(s, d):
    return groups.add_count(fx.segments(s, d).select("seg_id", "BLUE_LINE_KEY"), "BLUE_LINE_KEY")


def null_safe_left_join(s, d):
    df = fx.segments(s, d)
    left = df.select(*K3).distinct()
    right = df.groupBy("BLUE_LINE_KEY", "GNIS_NAME").agg(F.count("*").alias("n_segments"))
    return joins.left_join(left, right, ["BLUE_LINE_KEY", "GNIS_NAME"])


def first_match_join(s, d):
    keys = fx.segments(s, d).select("BLUE_LINE_KEY").distinct()
    hand = fx.expert_streams(s, d).where("BLUE_LINE_ <> '0'").select(
        to_int(F.col("BLUE_LINE_")).alias("BLUE_LINE_KEY"), "row_id", F.col("Summer_Sen").alias("stream_summer_sens"),
        F.col("Winter_Sen").alias("stream_winter_sens"))
    return joins.left_join_first(keys, hand, "BLUE_LINE_KEY", "row_id").drop("row_id")


def semi_join_stations(s, d):
    listed = fx.hydromaster(s, d).select(F.col("stream").alias("STATION_NAME"))
    return joins.semi_join(fx.stations(s, d), listed, "STATION_NAME").select("STATION_NUMBER", "STATION_NAME")


def anti_join_unmatched(s, d):
    hand = fx.expert_streams(s, d).select(to_int(F.col("BLUE_LINE_")).alias("BLUE_LINE_KEY"))
    return joins.anti_join(fx.segments(s, d), hand, "BLUE_LINE_KEY").select("seg_id", "BLUE_LINE_KEY")


def name_repair(s, d):
    return naming.name_correctors(fx.segments(s, d), "BLUE_LINE_KEY")


def name_repair_literal(s, d):
    return naming.name_correctors(fx.segments(s, d), "BLUE_LINE_KEY", mode="literal")


def repaired_segments(s, d):
    return naming.repair_names(fx.segments(s, d), "BLUE_LINE_KEY").select("seg_id", "GNIS_NAME")


def split_keyed(s, d):
    hand = fx.expert_streams(s, d)
    keyed = hand.where("BLUE_LINE_ <> '0'").select("row_id", F.lit("keyed").alias("part"))
    return keyed.union(hand.where("BLUE_LINE_ = '0'").select("row_id", F.lit("unkeyed")))


def union_by_name(s, d):
    return layers.merge_names([
        fx.ecosections(s, d).select("ECOSECTION_NAME", "summer_sens"),
        fx.regions(s, d).select("REGION_NAME"),
        fx.segments(s, d).select("ECOSECTION_NAME", "GNIS_NAME", "STREAM_ORDER"),
    ])


def variable_ties(s, d):
    return groups.top_tied(fx.crossings(s, d), "habitat_value", "final_score").select(
        "assessment_id", "habitat_value", "final_score")


# --- cleaning and stations --------------------------------------------------------------------------------

def fill_missing_values(s, d):
    filled = fill_missing(fx.crossings(s, d), keys=["assessment_id"])
    return filled.select("assessment_id", "fish_observed", "habitat_value", "final_score", "assessment_date")


def numeric_cleaning(s, d):
    df = fx.hydromaster(s, d).select("row_id", F.col("mad_l_s_text").alias("mad_l_s"))
    return clean_numeric(df, ["mad_l_s"])


def _sheet(s, d):
    return fx.hydromaster(s, d).select(
        "row_id", F.col("stream").alias("STATION_NAME"), F.col("mad_l_s_text").alias("mad_l_s"))


def station_table(s, d):
    return stations.station_table(fx.stations(s, d), _sheet(s, d)).select(
        "STATION_NUMBER", "STATION_NAME", "mad_l_s", *_ints("x", "y"))


def first_sheet_row(s, d):
    return groups.first_per(_sheet(s, d), "STATION_NAME", "row_id")


def sheet_promotion(s, d):
    body = fx.hydromaster(s, d).select(
        F.col("stream").alias("c1"), F.col("mad_l_s_text").alias("c2"), F.lit(None).cast("string").alias("c3"),
        (F.col("row_id") + 3).alias(sheets.ROW))
    head = body.where(F.col(sheets.ROW) == 3).select(
        F.lit("Stream Name").alias("c1"), F.lit("MAD L/s").alias("c2"), F.lit("none").alias("c3"), F.lit(2).cast("long").alias(sheets.ROW))
    table = sheets.promote_header(head.union(body), row=2, overrides={2: "Max_Summer"}, drop_last=1)
    return snake_columns(table).withColumnRenamed("row", "row_no")


def expert_sheet_flags(s, d):
    sheet = fx.expert_streams(s, d).select(
        "row_id", F.col("StreamName").alias("Stream"), F.col("Summer_Sen").alias("Summer Sensitive"),
        F.col("Winter_Sen").alias("Winter Sensitive"))
    return sheets.expert_flags(sheet)


def crossing_projection(s, d):
    raw = fx.crossings(s, d).withColumnsRenamed(
        {new: stations.CROSSING_COLUMNS[new] for new in ("assessment_date", "assessment_id", "fish_observed",
                                                         "habitat_value", "barrier", "final_score")})
    return stations.crossing_layer(raw).withColumns({c: F.col(c).cast("long") for c in "xy"})


# --- spatial joins ----------------------------------------------------------------------------------------

def _segment_edges(s, d):
    return geometry.edges(fx.segments(s, d), ["seg_id"])


def _crossing_pairs(s, d, radius):
    return spatial.lines_near_points(_segment_edges(s, d), "seg_id", fx.crossings(s, d), "assessment_id", radius, 1000)


def crossing_within_50m(s, d):
    return _crossing_pairs(s, d, 50)


def crossing_on_line(s, d):
    return _crossing_pairs(s, d, 0)


def species_overlay(s, d):
    return spatial.lines_in_polygons(fx.segments(s, d), spatial.ring_edges(fx.species(s, d), ["occ_id"]), "seg_id", "occ_id", 1000)


def region_overlay(s, d):
    return spatial.edges_in_boxes(_segment_edges(s, d), fx.regions(s, d), 50_000).select("seg_id", "region_id").distinct()


def _region_rings(s, d):
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax"), ("xmin", "ymin")]
    return fx.regions(s, d).select("region_id", geometry.line_geom(*corners).alias("geom"))


def polygon_overlay(s, d):
    rings = spatial.ring_edges(fx.regions(s, d), ["region_id"])
    return spatial.lines_in_polygons(fx.segments(s, d), rings, "seg_id", "region_id", 50_000)


def expert_overlay(s, d):
    hand = fx.expert_streams(s, d).where("BLUE_LINE_ = '0'")
    others = spatial.other_edges(geometry.edges(hand, ["row_id"]))
    return spatial.lines_on_lines(fx.segments(s, d), others, "seg_id", "row_id", 1000)


def name_matched_overlay(s, d):
    left = geometry.edges(fx.segments(s, d), ["seg_id", "GNIS_NAME"])
    others = spatial.other_edges(geometry.edges(fx.expert_streams(s, d), ["row_id", "StreamName"]))
    hits = spatial.edges_on_edges(left, others, 1000).where("GNIS_NAME = StreamName")
    return spatial.distinct_pairs(hits.select("seg_id", "row_id"), left, others, 1000)


def spatial_left_join(s, d):
    hand = fx.expert_streams(s, d)
    regions = fx.regions(s, d)
    pairs = spatial.lines_in_polygons(hand, spatial.ring_edges(regions, ["region_id"]), "row_id", "region_id", 50_000)
    return spatial.spatial_join(hand, regions.drop("geom"), pairs, "row_id", "region_id").select("row_id", "StreamName", "REGION_NAME")


def streams_by_section(s, d):
    hand = fx.expert_streams(s, d)
    sections = fx.ecosections(s, d)
    pairs = spatial.lines_in_polygons(hand, spatial.ring_edges(sections, ["eco_id"]), "row_id", "eco_id", 50_000)
    joined = spatial.spatial_join(hand, sections.drop("geom"), pairs, "row_id", "eco_id", how="inner")
    return joined.select("row_id", F.col("ECOSECTION_NAME").alias("EcoSection"))


# --- aggregates -------------------------------------------------------------------------------------------

def species_richness(s, d):
    return scoring.species_richness(_kept(s, d), fx.species(s, d))


def species_text(s, d):
    return scoring.species_lists(_kept(s, d), fx.crossings(s, d), fx.species(s, d), repeats=True)


def species_text_once(s, d):
    return scoring.species_lists(_kept(s, d), fx.crossings(s, d), fx.species(s, d))


def aquatic_species(s, d):
    return species.project(species.aquatic(fx.species(s, d)), {"occ_id": "occ_id", **species.SPECIES_COLUMNS})


def species_by_section(s, d):
    return species.species_by_section(fx.species(s, d))


def sections_with_species(s, d):
    joined = species.sections_with_species(fx.ecosections(s, d), fx.species(s, d))
    return joined.select("ECOSECTION_CODE", "summer_sens", "winter_sens", "number_sar")


def section_text_by_key(s, d):
    hand = fx.expert_streams(s, d).where("BLUE_LINE_ <> '0'")
    return groups.text_list(hand, "BLUE_LINE_", {"Ecosections": "Ecosection"}, "row_id")


def section_text_distinct(s, d):
    hand = fx.expert_streams(s, d).where("BLUE_LINE_ <> '0'")
    return groups.text_list(hand, "BLUE_LINE_", {"Ecosections": "Ecosection"}, "row_id", distinct=True)


# --- scoring ----------------------------------------------------------------------------------------------

def _scored(s, d):
    return scoring.score_streams(
        fx.segments(s, d), fx.ecosections(s, d), fx.crossings(s, d), fx.species(s, d), fx.expert_streams(s, d))


def drought_risk(s, d):
    return _scored(s, d).select(*K3, "drought_risk", "number_distinct_SAR")


def expert_coalesce(s, d):
    return _scored(s, d).select(*K3, "stream_summer_sens", "stream_winter_sens")


def harmonized_risk(s, d):
    return scoring.harmonized_streams(_scored(s, d)).select(*K3, "drought_risk", "number_distinct_SAR").distinct()


def drought_risk_by_rows(s, d):
    return score.drought_risk(_scored(s, d), ["BLUE_LINE_KEY", "GNIS_NAME"])


def drought_risk_max_variable(s, d):
    return score.drought_risk(_scored(s, d), ["BLUE_LINE_KEY", "GNIS_NAME"], combine="max_per_variable")


def top_200_risk(s, d):
    ties = [F.asc_nulls_last(c) for c in ("BLUE_LINE_KEY", "GNIS_NAME", "ECOSECTION_NAME")]
    return score.top_by_risk(_scored(s, d).select(*K3, "drought_risk"), 200, *ties)


def stream_delivery(s, d):
    kept = _kept(s, d)
    texts = scoring.species_lists(kept, fx.crossings(s, d), fx.species(s, d))
    return scoring.delivery_table(_scored(s, d), texts)


def keep_best_crossing(s, d):
    return variant.best_crossings(_kept(s, d), fx.crossings(s, d)).select(
        *variant.KEY, "assessment_id", "fish_observed", "habitat_value", "final_score")


def priority_rating(s, d):
    sections = species.sections_with_species(fx.ecosections(s, d), fx.species(s, d))
    return variant.rate_streams(fx.segments(s, d), sections, fx.crossings(s, d), sections)


def rated_lines(s, d):
    sections = species.sections_with_species(fx.ecosections(s, d), fx.species(s, d))
    lines = variant.rated_lines(fx.segments(s, d), sections, priority_rating(s, d))
    end = F.element_at(F.col("geom")[0], -1)
    return lines.select(*K3, *_part_start(), "priority_rating", F.size(F.col("geom")[0]).alias("n_vertices"),
                        F.round(end["x"], 6).alias("lon"), F.round(end["y"], 6).alias("lat"))


# --- lookup and reconciliation ----------------------------------------------------------------------------

def _requests(s, d):
    return fx.expert_streams(s, d).select("row_id", F.col("StreamName").alias("Stream"), "Ecosection")


def _looked_up(s, d, **options):
    found = lookup.lookup_streams(_requests(s, d), fx.segments(s, d), fx.ecosections(s, d), **options)
    return found.select("BLUE_LINE_KEY", "GNIS_NAME", "request_no", "n_edges", _mm("length_m"), "Ecosections")


def lookup_streams(s, d):
    return _looked_up(s, d)


def lookup_streams_repeated(s, d):
    return _looked_up(s, d, repeats=True)


def lookup_in_section(s, d):
    return lookup.requested_keys(_requests(s, d), fx.segments(s, d), fx.ecosections(s, d), match_section=True)


def lookup_unmatched(s, d):
    found = lookup.requested_keys(_requests(s, d), fx.segments(s, d), fx.ecosections(s, d))
    return lookup.unmatched_requests(_requests(s, d), found)


def _catalogue_lines(s, d):
    found = lookup.requested_keys(_requests(s, d), fx.segments(s, d), fx.ecosections(s, d))
    return lookup.lookup_lines(found, fx.segments(s, d))


def longer_than_gate(s, d):
    return reconcile.touching_longer(_catalogue_lines(s, d), fx.expert_streams(s, d))


def replace_geometry(s, d):
    hand = fx.expert_streams(s, d)
    streams = fx.segments(s, d).where("BLUE_LINE_KEY IS NOT NULL AND GNIS_NAME IS NOT NULL")
    updates = streams.groupBy("BLUE_LINE_KEY", "GNIS_NAME").agg(F.max("seg_id").alias("ord"))
    return reconcile.replace_geometry(hand, updates).select("row_id", "uniqID", "new_key", "new_name")


def reconcile_lines(s, d):
    merged = reconcile.reconcile(fx.expert_streams(s, d), _catalogue_lines(s, d))
    return merged.select(*reconcile.ALL_SEVEN, "replaced", "n_edges", _mm("length_m"))


def reconcile_overridden(s, d):
    hand = fx.expert_streams(s, d)
    listed = hand.where("row_id % 50 = 2").groupBy("BLUE_LINE_").agg(F.lit("Upland, Basin").alias("Ecosection"))
    merged = reconcile.reconcile(hand, _catalogue_lines(s, d), overrides=listed)
    return merged.select(*reconcile.ALL_SEVEN, "replaced", "n_edges", _mm("length_m"))


def column_duplicates(s, d):
    hand = fx.expert_streams(s, d).withColumn("geometry_id", F.col("row_id") % 700)
    flagged = groups.column_dupes(hand, ["geometry_id", "Summer_Sen", "Winter_Sen", "BLUE_LINE_"], "row_id")
    return flagged.select("row_id", "is_dup")


def manual_override(s, d):
    hand = fx.expert_streams(s, d)
    listed = hand.where("row_id % 50 = 2").groupBy("BLUE_LINE_").agg(F.lit("Upland, Basin").alias("Ecosection"))
    rows, united = reconcile.apply_overrides(hand, listed)
    sizes = geometry.dissolved_size(united, "BLUE_LINE_").select("BLUE_LINE_", "n_edges", _mm("length_m"))
    joined = joins.left_join(rows, sizes, "BLUE_LINE_")
    return joined.select(*reconcile.ALL_SEVEN, "n_edges", "length_mm")


# --- geometry ---------------------------------------------------------------------------------------------

def line_length(s, d):
    return geometry.with_length(fx.segments(s, d)).select("seg_id", _mm("length_m"))


def dissolve_counts(s, d):
    keys = ["BLUE_LINE_KEY", "GNIS_NAME"]
    sizes = geometry.dissolved_size(geometry.dissolve(fx.segments(s, d), keys), keys)
    return sizes.select(*keys, "n_edges", _mm("length_m"))


def dissolved_lines(s, d):
    lines = geometry.with_length(chains.dissolved_lines(fx.rivers(s, d), ["name"]))
    return lines.select("name", *_part_start(), "n_edges", _mm("length_m"))


def noded_union(s, d):
    sizes = geometry.dissolved_size(noding.node_edges(geometry.dissolve(fx.rivers(s, d), ["name"]), ["name"], 250), ["name"])
    return sizes.select("name", "n_edges", _mm("length_m"))


def noded_lines(s, d):
    lines = geometry.with_length(chains.dissolved_lines(fx.rivers(s, d), ["name"], cell=250))
    return lines.select("name", *[F.round(F.col(f"part.{c}") * 1000).cast("long").alias(c) for c in ("x", "y", "next_x", "next_y")],
                        "n_edges", _mm("length_m"))


def expert_dissolve(s, d):
    lines = reconcile.merge_hand_lines(geometry.drop_z(fx.expert_streams(s, d)))
    sizes = geometry.dissolved_size(lines, reconcile.ALL_SEVEN)
    return sizes.select(*reconcile.ALL_SEVEN, "n_edges", _mm("length_m"))


def equal_geometries(s, d):
    hashed = geometry.geom_hash(fx.segments(s, d).select("seg_id", "geom"))
    return hashed.groupBy("geom_hash").agg(F.min("seg_id").alias("first_seg"), F.count("*").alias("n")).drop("geom_hash")


def endpoint_search(s, d):
    return explorer.locate_streams(fx.expert_streams(s, d)).select("StreamName", *_ints("lng", "lat"))


def reproject_points(s, d):
    moved = geometry.reproject(fx.crossings(s, d).select("assessment_id", "x", "y"), 3005, 4326)
    return moved.select("assessment_id", F.round("x", 6).alias("lon"), F.round("y", 6).alias("lat"))


def reproject_lines(s, d):
    moved = geometry.reproject(fx.expert_streams(s, d).select("row_id", "geom"), 3005, 4326)
    start = F.col("geom")[0][0]
    return moved.select("row_id", F.round(start["x"], 6).alias("lon"), F.round(start["y"], 6).alias("lat"))


def reproject_back(s, d):
    points = fx.stations(s, d).select("STATION_NUMBER", "x", "y")
    there = geometry.reproject(points, 3005, 4326)
    back = geometry.reproject(there, 4326, 3005)
    return back.select("STATION_NUMBER", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


def simplify_by_tolerance(s, d):
    lines = simplify.simplify_tolerance(fx.segments(s, d).select("seg_id", "geom"), 20)
    return lines.select("seg_id", F.size(F.col("geom")[0]).alias("n_vertices"))


def simplify_by_share(s, d):
    lines = simplify.simplify_keep(fx.segments(s, d).select("seg_id", "geom"), 0.025)
    return lines.select("seg_id", F.size(F.col("geom")[0]).alias("n_vertices"))


def _checked(lines, *keep):
    """Number of vertices and a checksum of the whole coordinates of one-part lines."""
    part = F.col("geom")[0]
    total = F.aggregate(part, F.lit(0).cast("long"), lambda a, v: a + (v["x"] * 31 + v["y"] * 17).cast("long"))
    return lines.select(*keep, F.size(part).alias("n_vertices"), total.alias("vertex_sum"))


def simplify_rivers(s, d):
    return _checked(simplify.simplify_keep(fx.rivers(s, d), 0.1), "river_id")


def simplify_rivers_by_tolerance(s, d):
    return _checked(simplify.simplify_tolerance(fx.rivers(s, d), 40), "river_id")


def simplify_by_section(s, d):
    return _checked(simplify.simplify_by_section(fx.rivers(s, d), "ECOSECTION_NAME", 0.1), "river_id", "ECOSECTION_NAME")


def _part_start():
    return [F.col(f"part.{c}").cast("long").alias(c) for c in ("x", "y", "next_x", "next_y")]


def delivery_lines_simplified(s, d):
    lines = scoring.delivery_layer(_kept(s, d), _scored(s, d))
    end = F.element_at(F.col("geom")[0], -1)
    return lines.select(*K3, *_part_start(), "drought_risk", F.size(F.col("geom")[0]).alias("n_vertices"),
                        F.round(end["x"], 6).alias("lon"), F.round(end["y"], 6).alias("lat"))


def _checked_rings(polygons, *keep):
    """Rings and their vertices, the last of each not counted, with a checksum of all coordinates."""
    vertices = F.flatten(F.transform("geom", lambda ring: F.slice(ring, 2, F.size(ring) - 1)))
    total = F.aggregate(vertices, F.lit(0).cast("long"), lambda a, v: a + (v["x"] * 31 + v["y"] * 17).cast("long"))
    return polygons.select(*keep, F.size("geom").alias("n_rings"), F.size(vertices).alias("n_vertices"), total.alias("vertex_sum"))


def coverage_simplified(s, d):
    simple = coverage.simplify_coverage(fx.tiles(s, d), "tile_id", partial(simplify.simplify_keep, share=0.1))
    return _checked_rings(simple, "tile_id", "zone").drop("n_rings")


def common_borders(s, d):
    """Edges of a simplified layer by the number of polygons that have them."""
    simple = coverage.simplify_coverage(fx.tiles(s, d), "tile_id", partial(simplify.simplify_keep, share=0.1))
    owners = geometry.canonical(geometry.edges(simple, ["tile_id"])).groupBy(*geometry.EDGE).agg(F.count("*").alias("owners"))
    return geometry.dissolved_size(owners, "owners").select("owners", "n_edges", _mm("length_m"))


def species_simplified(s, d):
    return _checked_rings(species.species_layer(fx.species(s, d), "occ_id"), "occ_id", "scientific_name", "tax_class")


def region_simplified(s, d):
    rings = _region_rings(s, d).join(fx.regions(s, d).select("region_id", "REGION_NAME"), "region_id")
    simple = stations.region_layer(rings.withColumn("ORG_UNIT_NAME", F.col("REGION_NAME")))
    return simple.select("REGION_NAME", "ORG_UNIT_NAME", F.size(F.col("geom")[0]).alias("n_vertices"))


# --- scales -----------------------------------------------------------------------------------------------

def rescale_mad(s, d):
    df = scales.rescale(fx.hydromaster(s, d).select("row_id", "mad_l_s"), "mad_l_s", reverse=True)
    return df.select("row_id", F.round("scaled", 9).alias("scaled"))


def score_histogram(s, d):
    bins = scales.histogram(fx.crossings(s, d), "final_score", 30)
    return bins.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


def pretty_bins(s, d):
    df = scales.pretty_bins(fx.hydromaster(s, d).select("row_id", "mad_l_s"), "mad_l_s", 5)
    return df.select("row_id", "bin", F.round("bin_low", 6).alias("bin_low"))


def natural_breaks(s, d):
    return scales.natural_breaks(fx.crossings(s, d), "final_score", 5)


# --- explorer ---------------------------------------------------------------------------------------------

def _season(s, d, season):
    shown = explorer.sens_combo(explorer.sens_labels(fx.expert_streams(s, d)))
    shown = explorer.season_class(shown, season, LABELS)
    return shown.select("row_id", "sum_label", "wint_label", "sens_combo", "leaf_col")


def season_class_both(s, d):
    return _season(s, d, "Summer and Winter")


def season_class_summer(s, d):
    return _season(s, d, "Summer")


def season_class_winter(s, d):
    return _season(s, d, "Winter")


def region_filter_streams(s, d):
    shown = explorer.explorer_streams(fx.expert_streams(s, d), fx.regions(s, d), "Summer", REGION, LABELS)
    return shown.select("row_id", "StreamName", "leaf_col", "REGION_NAME")


def whole_province_streams(s, d):
    shown = explorer.explorer_streams(fx.expert_streams(s, d), fx.regions(s, d), "Winter", explorer.WHOLE, LABELS)
    return shown.select("row_id", "StreamName", "leaf_col", "REGION_NAME").orderBy("StreamName", "row_id")


def region_filter_stations(s, d):
    shown = explorer.explorer_stations(fx.stations(s, d), fx.regions(s, d), REGION)
    return shown.select("STATION_NUMBER", "STATION_NAME", "REGION_NAME")


def region_highlight(s, d):
    return explorer.region_highlight(fx.regions(s, d), REGION).select("REGION_NAME", "leaf_colour", "leaf_opac")


def stream_choices(s, d):
    return explorer.stream_names(fx.expert_streams(s, d))


def region_choices(s, d):
    return explorer.region_choices(fx.regions(s, d))


def stream_popup(s, d):
    return explorer.stream_popup(explorer.sens_labels(fx.expert_streams(s, d)))


def section_popup(s, d):
    return explorer.section_popup(fx.ecosections(s, d))


def rating_popup(s, d):
    kept = _kept(s, d)
    rated = joins.left_join(priority_rating(s, d), segments.key_levels(fx.segments(s, d)), "BLUE_LINE_KEY")
    return explorer.rating_popup(joins.left_join(rated, variant.best_crossings(kept, fx.crossings(s, d)), variant.KEY))


# --- sources and sinks ------------------------------------------------------------------------------------

def _place(s, d, name):
    return f"{shared_dir(s)}/freshet/{d.strip('/').replace('/', '_')}/{name}"


def layer_roundtrip(s, d):
    path = layers.write_layer(fx.crossings(s, d), _place(s, d, "crossings"))
    return layers.read_layer(s, path, ["assessment_id", "barrier", "final_score"]).where("final_score > 20")


def catalogue_by_name(s, d):
    path = layers.write_layer(fx.segments(s, d), _place(s, d, "catalogue"))
    return layers.read_layer(s, path).where("GNIS_NAME = 'CREEK_7'").select("seg_id", "BLUE_LINE_KEY")


def section_files(s, d):
    path = _place(s, d, "sections")
    segments.write_prepared(fx.segments(s, d), fx.ecosections(s, d), path)
    return layers.read_layers(s, path).select("seg_id", "ecosection_slug", "summer_sens")


def staged_layer(s, d):
    path = _place(s, d, "staged")
    layers.stage(s, path, lambda: fx.species(s, d).select("occ_id", "TAX_CLASS"), overwrite=True)
    return layers.stage(s, path, lambda: fx.species(s, d).where("false").select("occ_id", "TAX_CLASS"))


def csv_export(s, d):
    shown = explorer.explorer_streams(fx.expert_streams(s, d), fx.regions(s, d), "Summer", REGION, LABELS)
    shown = shown.select("StreamName", "row_id", "leaf_col", "geom")
    path = downloads.download(shown, "streams", _place(s, d, "csv"), REGION, order=["StreamName", "row_id"])
    return layers.read_csv(s, path, "row_number long, StreamName string, row_id long, leaf_col string")


def layer_export(s, d):
    shown = explorer.explorer_stations(fx.stations(s, d), fx.regions(s, d), REGION)
    shown = shown.drop("xmin", "ymin", "xmax", "ymax")
    path = downloads.download(shown, "stations", _place(s, d, "layer"), REGION, form="layer")
    return layers.read_layer(s, path).select("STATION_NUMBER", *_ints("x", "y"))


def section_export(s, d):
    shown = species.sections_with_species(fx.ecosections(s, d), fx.species(s, d))
    shown = shown.select("ECOSECTION_NAME", "summer_sens", "number_sar", "xmin", "ymin", "xmax", "ymax")
    path = downloads.download(shown, "sections", _place(s, d, "sections_csv"), REGION, order=["ECOSECTION_NAME"])
    return layers.read_csv(s, path, "row_number long, ECOSECTION_NAME string, summer_sens string, number_sar long")


def expert_layer(s, d):
    lines = experts.expert_layer(fx.rivers(s, d, hand=True))
    return _checked(lines, *reconcile.ALL_SEVEN, *_part_start())


def app_stream_layer(s, d):
    lines = experts.app_stream_layer(fx.expert_streams(s, d))
    start = F.col("geom")[0][0]
    return lines.select("row_id", F.size(F.col("geom")[0]).alias("n_vertices"),
                        F.round(start["x"], 6).alias("lon"), F.round(start["y"], 6).alias("lat"))


def species_matches(s, d):
    return scoring.species_matches(_kept(s, d), fx.species(s, d))


def crossing_counts(s, d):
    return scoring.crossing_counts(_kept(s, d), fx.crossings(s, d))


def station_registry(s, d):
    path = layers.write_layer(fx.stations(s, d), _place(s, d, "registry"))
    return layers.read_stations(s, path).select("STATION_NUMBER", "PROV_TERR_STATE_LOC")


def sheet_file(s, d):
    """A sheet staged as CSV: a line above the names, the names, then one line per row."""
    body = fx.hydromaster(s, d).select(F.col("stream").alias("c1"), F.col("mad_l_s_text").alias("c2"), F.lit(None).cast("string").alias("c3"),
                                       (F.col("row_id") + 3).alias(sheets.ROW))
    top = body.where(F.col(sheets.ROW) == 3)
    lines = top.select(F.lit("Table 1"), F.lit(None), F.lit(None), F.lit(1)).union(
        top.select(F.lit("Stream Name"), F.lit("MAD L/s"), F.lit("none"), F.lit(2))).union(body).toDF(*body.columns)
    path = _place(s, d, "sheet")
    lines.coalesce(1).sortWithinPartitions(sheets.ROW).drop(sheets.ROW).write.mode("overwrite").option("header", True).csv(path)
    table = sheets.promote_header(sheets.read_sheet(s, path, 3), row=2, drop_last=1)
    return snake_columns(table).withColumnRenamed("row", "row_no")


def station_points(s, d):
    registry = fx.stations(s, d).select("STATION_NUMBER", F.col("x").cast("string").alias("LONGITUDE"), F.col("y").cast("string").alias("LATITUDE"))
    return stations.station_points(registry).select("STATION_NUMBER", *_ints("x", "y"))


def dissolve_selection(s, d):
    chosen = fx.rivers(s, d).where("river_id % 2 = 0")
    return geometry.dissolved_size(geometry.dissolve(chosen, []), []).select("n_edges", _mm("length_m"))


def flat_lines(s, d):
    high = F.transform("geom", lambda p: F.transform(p, lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"), F.lit(7.0).alias("z"))))
    return _checked(geometry.drop_z(fx.rivers(s, d).withColumn("geom", high)), "river_id")


def dated_export(s, d):
    shown = explorer.explorer_streams(fx.expert_streams(s, d), fx.regions(s, d), "Summer", REGION, LABELS)
    path = downloads.download(shown.select("StreamName", "row_id"), "streams", _place(s, d, "dated"), REGION, order=["StreamName", "row_id"], date="2024-04-08")
    rows = layers.read_csv(s, path, "row_number long, StreamName string, row_id long")
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("file")).groupBy("file").agg(F.count("*").alias("n"))


def station_csv_export(s, d):
    shown = explorer.explorer_stations(fx.stations(s, d), fx.regions(s, d), REGION).select("STATION_NUMBER", "STATION_NAME", "x", "y")
    path = downloads.download(shown, "stations", _place(s, d, "stations_csv"), REGION, order=["STATION_NUMBER"])
    return layers.read_csv(s, path, "row_number long, STATION_NUMBER string, STATION_NAME string")


def stream_layer_export(s, d):
    shown = explorer.explorer_streams(fx.expert_streams(s, d), fx.regions(s, d), "Summer", REGION, LABELS)
    path = downloads.download(shown.select("row_id", "StreamName", "leaf_col", "geom"), "streams", _place(s, d, "streams_layer"), REGION, form="layer")
    return _checked(layers.read_layer(s, path), "row_id", "leaf_col")


def section_layer_export(s, d):
    shown = species.sections_with_species(fx.ecosections(s, d), fx.species(s, d)).select("ECOSECTION_NAME", "number_sar", "geom")
    path = downloads.download(shown, "sections", _place(s, d, "sections_layer"), REGION, form="layer")
    return _checked(layers.read_layer(s, path), "ECOSECTION_NAME", "number_sar")


def station_popup(s, d):
    shown = explorer.explorer_stations(fx.stations(s, d), fx.regions(s, d), REGION)
    return explorer.station_popup(shown).select("STATION_NUMBER", "STATION_NAME", "PROV_TERR_STATE_LOC")


def legend_values(s, d):
    return explorer.legend_values(fx.crossings(s, d), "final_score")


def expert_flag_counts(s, d):
    hand = fx.expert_streams(s, d)
    flags = {c: flag_to_int(F.col(c)) for c in ("Summer_Sen", "Winter_Sen")}
    return hand.withColumns(flags).groupBy("EcoProvinc").agg(
        F.sum("Summer_Sen").alias("summer"), F.sum("Winter_Sen").alias("winter"))


def delivery_lines(s, d):
    lines = scoring.delivery_lines(_kept(s, d), _scored(s, d))
    return lines.select("seg_id", "drought_risk", F.size(F.col("geom")[0]).alias("n_vertices"))


def registry():
    """All public functions of this module with the (spark, folder) signature, by name."""
    return {
        name: f for name, f in globals().items()
        if callable(f) and not name.startswith("_") and name != "registry" and getattr(f, "__module__", "") == __name__
    }
