"""Hydrometric stations and their attribute sheet; region layer; crossing layer."""

from pyspark.sql import functions as F

from freshet.functions.nulls import clean_numeric
from freshet.functions.text import snake_columns
from freshet.operators.geometry import points_from
from freshet.operators.groups import first_per
from freshet.operators.joins import left_join, semi_join
from freshet.operators.simplify import simplify_tolerance
from freshet.plans.species import project
from freshet.sources.sheets import ROW, promote_header

# Sheet positions renamed by hand, dropped columns, numeric columns, crossing column names.
SHEET_NAMES = {18: "Max_Summer", 19: "Min_Summer", 21: "Max_Winter", 22: "Min_Winter"}
DROPPED = ["PROV_TERR_STATE_LOC", "TIMEZONE", "wsc", "eco_province", "eco_section", "eco_section_code",
           "eco_region_code", "order"]
NUMERIC = ["years_record", "da_km_2", "mad_l_s", "runoff_l_s_km_2", "mm_yr", "20_mad", "summer_cpsf_mad",
           "max_summer", "min_summer", "winter_cpsf_mad", "max_winter", "min_winter", "lwy_fraction", "hwy_fraction"]
CROSSING_COLUMNS = {
    "assessment_date": "ASSESSMENT_DATE",
    "assessment_id": "ASSESSMENT_ID",
    "stream_name": "STREAM_NAME",
    "road_name": "ROAD_NAME",
    "crossing_type": "CROSSING_TYPE_DESC",
    "crossing_subtype": "CROSSING_SUBTYPE_DESC",
    "diameter_or_span": "DIAMETER_OR_SPAN",
    "length_or_width": "LENGTH_OR_WIDTH",
    "percent_backwatered": "PERCENTAGE_BACKWATERED",
    "fill_depth": "FILL_DEPTH",
    "outlet_drop": "OUTLET_DROP",
    "outlet_pool_depth": "OUTLET_POOL_DEPTH",
    "downstream_channel_width": "DOWNSTREAM_CHANNEL_WIDTH",
    "culvert_slope": "CULVERT_SLOPE",
    "stream_slope": "STREAM_SLOPE",
    "fish_observed": "FISH_OBSERVED_IND",
    "valley_fill": "VALLEY_FILL_CODE_DESC",
    "habitat_value": "HABITAT_VALUE_DESC",
    "barrier": "BARRIER_RESULT_DESCRIPTION",
    "final_score": "FINAL_SCORE",
}


def sheet_table(sheet):
    """The staged attribute sheet with proper names; STATION_NAME is the sheet's stream column."""
    return snake_columns(promote_header(sheet, 2, SHEET_NAMES, 2).withColumnRenamed(ROW, "row_id"), stream="STATION_NAME")


def station_table(registry, sheet, order="row_id"):
    """Registry stations that the sheet lists, with the first sheet row of each name and rounded numbers."""
    first = first_per(sheet, "STATION_NAME", order)
    listed = semi_join(registry, sheet, "STATION_NAME")
    joined = left_join(listed, first.drop(order), "STATION_NAME").drop(*DROPPED)
    return clean_numeric(joined, [c for c in NUMERIC if c in joined.columns])


def region_layer(regions, tolerance=100):
    """Region polygons, simplified, with their two names."""
    return simplify_tolerance(regions, tolerance).select("REGION_NAME", "ORG_UNIT_NAME", "geom")


def crossing_layer(raw):
    """The twenty crossing columns under their short names, with the point."""
    return project(raw, {**CROSSING_COLUMNS, "x": "x", "y": "y"})


def station_points(registry):
    """Registry coordinates as points in longitude and latitude."""
    return points_from(registry, "LONGITUDE", "LATITUDE").drop("LONGITUDE", "LATITUDE")
