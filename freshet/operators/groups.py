"""Per-key operators. None of them brings all rows of a key into one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.functions.nulls import text_or_na
from freshet.functions.ordinal import decode, encode
from freshet.operators.joins import HEAVY_ROWS, _as_list, join_back


def first_per(df, keys, order):
    """First row of each key in the given order.

    Spark keeps one row per key and map task before the shuffle (WindowGroupLimit), so a heavy key
    costs no more than a light one.
    """
    order = order if isinstance(order, (list, tuple)) else [order]
    window = Window.partitionBy(*_as_list(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def keep_best(df, key, score, order):
    """The row with the highest score per key; nulls lose, ties go to the lowest order key."""
    return first_per(df, key, [F.desc_nulls_last(score), F.asc(order)])


def top_tied(df, keys, value):
    """All rows that reach the highest value of their key, nulls apart."""
    best = df.groupBy(*_as_list(keys)).agg(F.max(value).alias("__best"), F.count("*").alias("__n"))
    joined = join_back(df, best, keys, weight="__n")
    return joined.where(F.col(value) == F.col("__best")).drop("__best")


def count_by(df, keys, name="n"):
    """Row count per key, largest first."""
    keys = _as_list(keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), *[F.asc_nulls_last(k) for k in keys])


def add_count(df, keys, name="n", heavy_rows=HEAVY_ROWS):
    """The row count of the key on every row."""
    counts = df.groupBy(*_as_list(keys)).agg(F.count("*").alias("__n"), F.count("*").alias(name))
    return join_back(df, counts, keys, weight="__n", heavy_rows=heavy_rows)


def max_level(df, key, cols, levels, heavy_rows=HEAVY_ROWS):
    """Overwrite each ordinal column by the highest level found anywhere in the key."""
    best = df.groupBy(*_as_list(key)).agg(
        F.count("*").alias("__n"),
        *[F.max(encode(F.col(c), levels)).alias(f"__{c}") for c in cols],
    )
    joined = join_back(df, best, key, weight="__n", heavy_rows=heavy_rows)
    joined = joined.withColumns({c: decode(F.col(f"__{c}"), levels) for c in cols})
    return joined.drop(*[f"__{c}" for c in cols])


def column_dupes(df, cols, order, heavy_rows=HEAVY_ROWS):
    """Flag rows whose value in EVERY listed column, taken one column at a time, occurred earlier.

    The flag of a column needs only the first order key of each value, so each column costs one small
    aggregate, however many rows share a value.
    """
    flagged = df.withColumn("is_dup", F.lit(True))
    for c in cols:
        first = df.groupBy(c).agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
        flagged = join_back(flagged, first, c, weight="__n", heavy_rows=heavy_rows)
        flagged = flagged.withColumn("is_dup", F.col("is_dup") & (F.col(order) > F.col("__first"))).drop("__first")
    return flagged


def text_list(df, keys, values, order, distinct=False, sep=", "):
    """One text per key and value column: all values in order, repeats and nulls (as NA) included.

    Rows are first spread by ranges of (key, order), so that a heavy key is joined piecewise in many
    tasks; the pieces, one per key and range, are then joined in range order. `order` must be unique
    within a key. `distinct` keeps the first occurrence of each value (one value column only).
    """
    keys, order = _as_list(keys), _as_list(order)
    if distinct:
        (value,) = values
        df = df.groupBy(*keys, F.col(values[value]).alias(values[value])).agg(F.min(F.struct(*order)).alias("__o"))
        df = df.select(*keys, values[value], *[F.col(f"__o.{o}").alias(o) for o in order])
    pieces = df.select(
        *keys, F.struct(*order).alias("__ord"),
        *[text_or_na(F.col(source)).alias(f"__{name}") for name, source in values.items()],
    ).repartitionByRange(*keys, "__ord").withColumn("__piece", F.spark_partition_id())

    pieces = join_texts(pieces, [*keys, "__piece"], [f"__{name}" for name in values], "__ord", sep)
    whole = join_texts(pieces, keys, [f"__{name}" for name in values], "__piece", sep)
    return whole.withColumnsRenamed({f"__{name}": name for name in values})


def join_texts(pieces, keys, texts, by, sep=", "):
    """The texts of each key as one, in the order of `by`."""
    return pieces.groupBy(*keys).agg(*[F.expr(f"listagg(`{c}`, '{sep}') WITHIN GROUP (ORDER BY {by})").alias(c) for c in texts])
