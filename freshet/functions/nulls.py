"""Null, cast and text rules that differ from Spark's defaults."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


def not_in(col, values):
    """Keep-condition for values outside a list; a null is outside every list."""
    return ~F.coalesce(col.isin(*values), F.lit(False))


def sum0(col):
    """Sum that skips nulls and gives 0 when every value is null."""
    return F.coalesce(F.sum(col), F.lit(0))


def row_sum0(*cols):
    """Sum across columns of one row, nulls counted as 0."""
    return reduce(Column.__add__, [F.coalesce(c, F.lit(0)) for c in cols])


def text_or_na(col):
    """The text of a value, with a null spelled NA."""
    return F.coalesce(col.cast("string"), F.lit("NA"))


def paste(*cols):
    """Concatenate texts; a null contributes the letters NA."""
    return F.concat(*[text_or_na(c) for c in cols])


def flag_to_int(col):
    """'Y' is 1, any other text 0, null stays null."""
    return F.when(col.isNull(), F.lit(None).cast("int")).otherwise((col == "Y").cast("int"))


def to_int(col):
    return col.try_cast("int")


def to_num(col):
    return col.try_cast("double")


def to_str(col):
    return col.cast("string")


def clean_numeric(df, cols, digits=2):
    """Lenient numeric cast of text columns, rounded half to even."""
    return df.withColumns({c: F.bround(to_num(F.col(f"`{c}`")), digits) for c in cols})


def fill_missing(df, keys=(), number=0, text=UNKNOWN):
    """Numeric nulls become `number`, text nulls `text`; key, date and other columns stay as they are."""
    fills = {}
    for field in df.schema.fields:
        if field.name in keys:
            continue
        if isinstance(field.dataType, T.NumericType):
            fills[field.name] = F.coalesce(F.col(field.name), F.lit(number).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            fills[field.name] = F.coalesce(F.col(field.name), F.lit(text))
    return df.withColumns(fills) if fills else df


def coalesce_sources(df, pairs):
    """Prefer each column, fall back to its partner, and drop the partner."""
    merged = df.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs.items()})
    return merged.drop(*pairs.values())
