"""Tables behind the interactive map: streams, stations and regions by season and region."""

from pyspark.sql import functions as F

from freshet.functions.nulls import paste
from freshet.functions.text import strip_region
from freshet.operators.geometry import boundary_points
from freshet.operators.spatial import lines_in_polygons, points_meet_polygons, ring_edges, spatial_join
from freshet.plans.species import project
from freshet.sources.layers import GEOMETRY

WHOLE = "Whole Province"

# Display texts, popup headings and the station data dictionary.
YES, NO = "Yes (<20% MAD)", "No (>=20% MAD)"
CLASSES = {
    "Summer and Winter": {"none": ["NN"], "some": ["YN", "NY"], "all": ["YY"]},
    "Summer": {"none": ["NN", "NY"], "all": ["YN", "YY"]},
    "Winter": {"none": ["NN", "YN"], "all": ["NY", "YY"]},
}
STREAM_POPUP = {
    "Name": "GNIS_NAME",
    "Stream Summer Sensitivity": "sum_label",
    "Stream Winter Sensitivity": "wint_label",
}
SECTION_POPUP = {
    "Name": "ECOSECTION_NAME",
    "Winter Sensitivity": "winter_sens",
    "Summer Sensitivity": "summer_sens",
}
RATING_POPUP = {
    "Name": "GNIS_NAME",
    "Summer Sensitivity": "summer_sens",
    "Winter Sensitivity": "winter_sens",
    "Assessment Date": "assessment_date",
    "Fish Observed": "fish_observed",
    "Crossing Type": "crossing_type",
    "Crossing Subtype": "crossing_subtype",
    "Barrier": "barrier",
    "Habitat Value": "habitat_value",
    "Priority Rating": "priority_rating",
}
STATION_VARIABLES = {
    "STATION_NUMBER": "Water Survey Canada Hydrometric Station Number",
    "STATION_NAME": "Water Survey Canada Hydrometric Station Name",
    "location": "Relative location in stream; possible values: lower, mid, upper",
    "state": 'One of natural ("Nat") or "regulated" ("Reg"), i.e. the stream has point(s) of diversion/augmentation upstream of station',
    "years_record": "Number of years for which critical flow periods could be calculated",
    "da_km_2": "Drainage Area in square kilometers",
    "mad_l_s": "Mean Annual Discharge in litres per second",
    "runoff_l_s_km_2": "Annual runoff in litres per second per drainage area",
    "mm_year": "Annual runoff in millimeters per year",
    "20_mad": "20% threshold of Mean Annual Discharge",
    "alt_type": "Alteration type: diversion (D), augmentation (A), or none (N)",
    "summer_cpsf_mad": "Percentage of Mean Annual Discharge during month with lowest average flows during Critical Period Stream Flows in Summer",
    "max_summer": "Maximum value during the CPSF summer period, as percent",
    "min_summer": "Minimum value during the CPSF summer period, as percent",
    "winter_cpsf_mad": "Percentage of Mean Annual Discharge during month with lowest average flows during Critical Period Stream Flows in Winter",
    "max_winter": "Maximum value during the CPSF winter period, as percent",
    "min_winter": "Minimum value during the CPSF winter period, as percent",
    "lwy_fraction": "low-water yield (measure of variability of annual run-off as fraction of long-term mean)",
    "hwy_fraction": "high-water yield (measure of variability of annual run-off as fraction of long-term mean)",
}


def sens_labels(df):
    """Seasonal flags as display text; a missing flag has no text."""
    def label(c):
        return F.when(F.col(c) == "Y", YES).when(F.col(c).isNotNull(), NO)

    return df.withColumns({"sum_label": label("Summer_Sen"), "wint_label": label("Winter_Sen")})


def sens_combo(df):
    """Summer and winter flag as one code; a missing flag is spelled NA."""
    return df.withColumn("sens_combo", paste(F.col("Summer_Sen"), F.col("Winter_Sen")))


def season_class(df, season, labels):
    """Class label of each stream for a season; codes outside the classes have none.

    `labels` maps none, some and all to the text to show.
    """
    chain = None
    for name, codes in CLASSES[season].items():
        hit, text = F.col("sens_combo").isin(*codes), F.lit(labels[name])
        chain = F.when(hit, text) if chain is None else chain.when(hit, text)
    return df.withColumn("leaf_col", chain)


def filter_region(df, region):
    """Rows of one region by its short name; the whole province keeps all rows."""
    return df if region == WHOLE else df.where(strip_region(F.col("REGION_NAME")) == region)


def explorer_streams(hand, regions, season, region, labels, cell=50_000):
    """Streams with display columns and class, matched to regions; a stream in two regions appears twice."""
    shown = season_class(sens_combo(sens_labels(hand)), season, labels)
    pairs = lines_in_polygons(hand, ring_edges(regions, ["region_id"]), "row_id", "region_id", cell)
    return filter_region(spatial_join(shown, regions.drop("geom"), pairs, "row_id", "region_id"), region)


def explorer_stations(stations, regions, region, cell=50_000):
    """Stations matched to regions."""
    points = stations.select("STATION_NUMBER", "x", "y")
    pairs = points_meet_polygons(points, ring_edges(regions, ["region_id"]), "STATION_NUMBER", "region_id", cell)
    return filter_region(spatial_join(stations, regions.drop("geom"), pairs, "STATION_NUMBER", "region_id"), region)


def region_highlight(regions, region):
    """Line colour and opacity of each region for a selection."""
    chosen = F.lit(True) if region == WHOLE else strip_region(F.col("REGION_NAME")) == region
    return regions.withColumns({
        "leaf_colour": F.when(chosen, "black").otherwise("lightgrey"),
        "leaf_opac": F.when(chosen, 1.0).otherwise(0.5),
    })


def stream_names(hand):
    """Names to choose from, sorted."""
    return hand.select("StreamName").distinct().orderBy(F.asc_nulls_last("StreamName"))


def region_choices(regions):
    """Short region names to choose from, the whole province first."""
    names = regions.select(strip_region(F.col("REGION_NAME")).alias("choice"), F.lit(1).alias("at")).distinct()
    spark = regions.sparkSession
    return spark.createDataFrame([(WHOLE, 0)], "choice string, at int").union(names).orderBy("at", "choice").select("choice")


def locate_streams(hand):
    """Per stream name, the first boundary point of its first line that has one, in row and part order."""
    ends = boundary_points(hand, ["StreamName", "row_id"])
    first = ends.groupBy("StreamName").agg(F.min(F.struct("row_id", "end_no", "x", "y")).alias("p"))
    return first.select("StreamName", F.col("p.x").alias("lng"), F.col("p.y").alias("lat"))


def locate_stream(hand, name):
    """Position to show for a searched stream; a closed line has none."""
    return locate_streams(hand.where(F.col("StreamName") == name)).select("lng", "lat")


def stream_popup(streams):
    return project(streams, STREAM_POPUP)


def section_popup(sections):
    return project(sections, SECTION_POPUP)


def rating_popup(streams):
    return project(streams, RATING_POPUP)


def station_popup(stations):
    """All attributes of the stations that are shown."""
    return stations.drop(*GEOMETRY)


def legend_values(df, col):
    """Distinct values of a legend, the highest first."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(F.desc(col))


def data_dictionary(spark):
    """Station variables and their definitions, unpivoted from one wide row."""
    wide = spark.range(1).select(*[F.lit(text).alias(name) for name, text in STATION_VARIABLES.items()])
    return wide.unpivot([], wide.columns, "Variable", "Definition")
