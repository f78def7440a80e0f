"""Spreadsheets staged as CSV: every cell is text and every row carries its place."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.nulls import flag_to_int

ROW = "__row"


def read_sheet(spark, path, width):
    """All cells below the sheet's first line as text, with the row's place among them in `__row`.

    A staged sheet is a single small file; the place is taken from the reading order of that file.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, width + 1)])
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).csv(path)
    return df.withColumn(ROW, F.monotonically_increasing_id() + 1)


def promote_header(df, row=2, overrides=None, drop_last=2):
    """Take the names from the given data row, drop the rows up to it and the last columns.

    `overrides` sets names by 1-based column position. Only the header row comes to the driver.
    """
    cells = [c for c in df.columns if c != ROW]
    header = df.where(F.col(ROW) == row).select(*cells).first()
    names = [str(v) if v is not None else "NA" for v in header]
    for position, name in (overrides or {}).items():
        names[position - 1] = name
    kept = cells[: len(cells) - drop_last]
    body = df.where(F.col(ROW) > row)
    return body.select(ROW, *[F.col(c).alias(n) for c, n in zip(kept, names)])


def expert_flags(df):
    """Rename the sheet's stream and flag columns; flags become 1 for 'Y', 0 for other text."""
    renamed = df.withColumnsRenamed({
        "Stream": "GNIS_NAME",
        "Summer Sensitive": "summer_sens_expert_id",
        "Winter Sensitive": "winter_sens_expert_id",
    })
    flags = ("summer_sens_expert_id", "winter_sens_expert_id")
    return renamed.withColumns({c: flag_to_int(F.col(c)) for c in flags})
