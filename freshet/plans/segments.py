"""Segment preparation: highest sensitivity per stream, known sections, order and source filters."""

from pyspark.sql import functions as F

from freshet.functions.nulls import not_in
from freshet.functions.ordinal import SENSITIVITY, decode, encode
from freshet.operators.groups import max_level
from freshet.operators.joins import semi_join
from freshet.sources.layers import write_by_section

SEASONAL = ["summer_sens", "winter_sens"]
DROPPED_SOURCES = ["lake-def skelet", "OP"]  # fixed values: sources that are not stream lines


def spread_sensitivity(segments):
    """Every segment of a key gets the key's highest summer and winter level, over all sections."""
    return max_level(segments, "BLUE_LINE_KEY", SEASONAL, SENSITIVITY)


def key_levels(segments):
    """The highest levels as one row per key, for use at stream level."""
    ranks = segments.groupBy("BLUE_LINE_KEY").agg(
        *[F.max(encode(F.col(c), SENSITIVITY)).alias(c) for c in SEASONAL])
    return ranks.withColumns({c: decode(F.col(c), SENSITIVITY) for c in SEASONAL})


def keep_streams(segments, ecosections, min_order=2):
    """Segments of known sections, above the given stream order, from true stream sources."""
    known = semi_join(segments, ecosections, "ECOSECTION_NAME")
    return known.where((F.col("STREAM_ORDER") > min_order) & not_in(F.col("FEATURE_SOURCE"), DROPPED_SOURCES))


def prepare_segments(segments, ecosections):
    return keep_streams(spread_sensitivity(segments), ecosections)


def write_prepared(segments, ecosections, path):
    return write_by_section(prepare_segments(segments, ecosections), path)
