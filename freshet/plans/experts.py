"""Expert stream layer and its light form for the map."""

from pyspark.sql import functions as F

from freshet.functions.nulls import to_str
from freshet.operators.chains import dissolved_lines
from freshet.operators.geometry import drop_z, reproject
from freshet.operators.simplify import simplify_keep, simplify_tolerance
from freshet.plans.reconcile import ALL_SEVEN


def expert_layer(hand, share=0.05):
    """Hand lines without Z, the key as text, dissolved on their seven attributes and generalised over the layer: one row
    per attributes and part."""
    flat = drop_z(hand).withColumn("BLUE_LINE_", to_str(F.col("BLUE_LINE_")))
    return simplify_keep(dissolved_lines(flat, ALL_SEVEN), share)


def app_stream_layer(hand, tolerance=50):
    """The layer as the map shows it: simplified by tolerance, in longitude and latitude."""
    return reproject(simplify_tolerance(hand, tolerance), 3005, 4326)
