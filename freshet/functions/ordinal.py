"""Ordered categories: a text column plus the list of its levels, lowest first."""

from pyspark.sql import functions as F

# The category levels used by the scoring, lowest first.
SENSITIVITY = ["Not Sensitive", "Sensitive Proceed with caution", "Very Sensitive--Chronic Problems"]
FISH = ["N", "Y"]
HABITAT = ["Low habitat value", "Medium habitat value", "High habitat value"]


def encode(col, levels, base=0):
    """Rank of a value among its levels, counted from `base`; values outside the levels are null."""
    rank = F.when(col == levels[0], F.lit(base))
    for i, level in enumerate(levels[1:], start=base + 1):
        rank = rank.when(col == level, F.lit(i))
    return rank


def decode(rank, levels, base=0):
    """The level text of a rank; null stays null."""
    text = F.when(rank == base, F.lit(levels[0]))
    for i, level in enumerate(levels[1:], start=base + 1):
        text = text.when(rank == i, F.lit(level))
    return text
