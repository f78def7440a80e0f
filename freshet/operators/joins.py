"""Equi-joins that match null with null, and their skew-safe forms."""

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

HEAVY_ROWS = 1_000_000  # a key with more rows than this is spread over several tasks
MAX_HEAVY = 10_000      # a listed key holds more than this part of all heavy rows, so fewer keys than this are listed
SALTS = 64


def _as_list(on):
    return [on] if isinstance(on, str) else list(on)


def _null_safe(left, right, on, how):
    on = _as_list(on)
    alias = {k: f"__r_{i}" for i, k in enumerate(on)}
    right = right.withColumnsRenamed(alias)
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(alias[k])) for k in on])
    return left.join(right, match, how).drop(*alias.values())


def left_join(left, right, on):
    """Left equi-join in which a null key matches a null key."""
    return _null_safe(left, right, on, "left")


def inner_join(left, right, on):
    """Inner equi-join in which a null key matches a null key."""
    return _null_safe(left, right, on, "inner")


def semi_join(left, right, on):
    """Rows of `left` whose key occurs in `right`."""
    return _null_safe(left, right.select(*_as_list(on)), on, "left_semi")


def anti_join(left, right, on):
    """Rows of `left` whose key does not occur in `right`; a null key matches only a null key."""
    return _null_safe(left, right.select(*_as_list(on)), on, "left_anti")


def heavy_keys(counts, on, weight="n", heavy_rows=HEAVY_ROWS):
    """Keys with at least `heavy_rows` rows that hold more than a MAX_HEAVY-th of all rows of such keys.

    The list is complete by that rule and shorter than MAX_HEAVY; the window sees one row per heavy key.
    """
    on = _as_list(on)
    top = counts.where(F.col(weight) >= heavy_rows).select(*on, F.col(weight).alias("__n"))
    share = F.col("__n") * MAX_HEAVY > F.sum("__n").over(Window.partitionBy())
    return top.withColumn("__heavy", share).where("__heavy").drop("__n")


def spread_join(left, right, on, heavy, how="left", salts=SALTS):
    """Null-safe join whose heavy keys are salted.

    `heavy` comes from heavy_keys, so its broadcast is shorter than MAX_HEAVY rows. Rows of a heavy key
    take their salt from the input partition they sit in (stable when a task is run again), and the
    matching right rows are repeated once per salt. All other keys keep salt 0.
    """
    on = _as_list(on)
    heavy = F.broadcast(heavy)
    salted_left = left_join(left, heavy, on).withColumn(
        "__salt", F.when(F.col("__heavy"), F.spark_partition_id() % salts).otherwise(0)
    ).drop("__heavy")
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = left_join(right, heavy, on).withColumn(
        "__salt", F.explode(F.when(F.col("__heavy"), all_salts).otherwise(F.array(F.lit(0))))
    ).drop("__heavy")
    return _null_safe(salted_left, salted_right, on + ["__salt"], how).drop("__salt")


def join_back(rows, per_key, on, weight="n", heavy_rows=HEAVY_ROWS):
    """Write per-key values on every row of the key.

    `per_key` holds one row per key with its row count in `weight`. Together with a pre-aggregated
    `per_key` this replaces an unordered window, which would put a whole key into one task.
    """
    heavy = heavy_keys(per_key, on, weight, heavy_rows)
    return spread_join(rows, per_key.drop(weight), on, heavy)


def left_join_first(left, right, on, order):
    """Left join to the first right row of each key."""
    from freshet.operators.groups import first_per

    return left_join(left, first_per(right, on, order), on)
