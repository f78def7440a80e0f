"""Read and write layers, folders of sections, materialised stages and exports.

A layer is a Parquet data set with its geometry as nested arrays (`geom`), box columns or point columns.
"""

import datetime
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.functions.text import snake_value
from freshet.session import shared_dir

GEOMETRY = ["geom", "areas", "x", "y", "xmin", "ymin", "xmax", "ymax"]


def read_layer(spark, path, columns=None, schema=None):
    """Scan a layer; filters and column choices put on the result reach the file scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_stations(spark, path, province="BC"):
    """Station registry of one province; the filter reaches the file scan."""
    return spark.read.parquet(path).where(F.col("PROV_TERR_STATE_LOC") == province)


def read_layers(spark, folder):
    """All files below a folder as one table; columns are matched by name, missing ones are null."""
    return spark.read.option("mergeSchema", True).parquet(folder)


def write_layer(df, path, mode="overwrite"):
    """Write a layer, by default in place of an earlier one."""
    df.write.mode(mode).parquet(path)
    return path


def write_by_section(df, path, section="ECOSECTION_NAME"):
    """One folder per section, named by its snake-cased value.

    Rows are gathered by section first, so that not every task writes a file for every section; the rebalance
    splits a large section over several tasks.
    """
    slugged = df.withColumn("ecosection_slug", snake_value(F.col(section))).hint("rebalance", "ecosection_slug")
    slugged.write.mode("overwrite").partitionBy("ecosection_slug").parquet(path)
    return path


def _exists(spark, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def stage(spark, path, build, overwrite=False):
    """Read a finished stage if it is there, else build, write and read it."""
    if overwrite or not _exists(spark, path):
        write_layer(build(), path)
    return spark.read.parquet(path)


def materialise(df, label):
    """Write an intermediate table to a fresh place in the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/freshet/{label}-{uuid.uuid4().hex}"
    write_layer(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_name(kind, region="Whole Province", date=None):
    """Dated file name of a download; a chosen region is part of the name."""
    day = date or datetime.date.today()
    tag = "" if region == "Whole Province" else f"{region}_"
    return f"{kind}_Drought_Sensitivity_{tag}{day}"


def export_layer(df, folder, kind, region="Whole Province", date=None):
    """Download with geometry."""
    return write_layer(df, f"{folder}/{export_name(kind, region, date)}")


def export_csv(df, folder, kind, region="Whole Province", order=None, date=None):
    """Download of the attributes as CSV with a header and a leading row number.

    Rows are range-sorted by `order`; the number of a row is its place in its range plus the sizes of the
    ranges before it, so numbering needs no single task.
    """
    path = f"{folder}/{export_name(kind, region, date)}.csv"
    plain = df.drop(*[c for c in df.columns if c in GEOMETRY])
    numbered = number_rows(plain, order or plain.columns[:1])
    numbered.write.mode("overwrite").option("header", True).csv(path)
    return path


def number_rows(df, order, name="row_number"):
    """Consecutive numbers from 1 in the given order of names or sort columns (ties by the other columns), without a single-task window.

    The rows are sorted into ranges and written once, so that the ranges stay fixed; each range is then
    numbered on its own and shifted by the sizes of the ranges before it (one row per range).
    """
    named = [c for c in order if isinstance(c, str)]
    order = [*order, *[c for c in df.columns if c not in named]]
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    joined = ranged.withColumn("__rn", within).join(F.broadcast(starts), "__range")
    return joined.select((F.col("__rn") + F.col("__start")).alias(name), *df.columns)


def read_csv(spark, path, schema):
    return spark.read.option("header", True).schema(schema).csv(path)


def merge_names(parts):
    """Union by column name, missing columns null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
