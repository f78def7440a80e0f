"""Session defaults and the shared folder for materialised stages."""

import tempfile

from pyspark.sql import SparkSession

_fallback_dir = None


def build_session(app="freshet", master=None, **conf):
    """A session with adaptive execution on; pass `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may go without that setting; it then gets a fresh temporary folder.
    """
    global _fallback_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="freshet-")
    return _fallback_dir
