"""Snake-case names and values."""

import re

from pyspark.sql import functions as F


def snake(name):
    """Snake-case a column name: split at case changes and digit runs, lower, join with underscores."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)
    return "_".join(words).lower()


def snake_columns(df, **renames):
    """Snake-case every column name, then apply the renames."""
    names = [snake(c) for c in df.columns]
    return df.toDF(*[renames.get(n, n) for n in names])


def snake_value(col):
    """Snake-case a text value, for use in partition names."""
    dashed = F.regexp_replace(col, "[^A-Za-z0-9]+", "_")
    spaced = F.regexp_replace(dashed, "([a-z])([A-Z0-9])", "$1_$2")
    spaced = F.regexp_replace(spaced, "([0-9])([A-Za-z])", "$1_$2")
    return F.lower(F.regexp_replace(spaced, "^_+|_+$", ""))


def strip_region(col):
    """Region name without the words from ' Natural' on."""
    return F.regexp_replace(col, " Natural.*", "")
