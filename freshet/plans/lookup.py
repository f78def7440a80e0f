"""Find listed streams in the catalogue of named segments, all names in one job."""

from pyspark.sql import functions as F

from freshet.operators.geometry import dissolve, dissolved_size
from freshet.operators.groups import text_list
from freshet.operators.joins import anti_join, inner_join, left_join, semi_join
from freshet.operators.spatial import lines_in_polygons, ring_edges
from freshet.sources.layers import materialise

STREAM = ["BLUE_LINE_KEY", "GNIS_NAME"]
RUN_BYTES = 8_000_000     # of repeated lists that come from one row
TASK_BYTES = 250_000_000  # of repeated lists that a task writes


def section_matches(requests, catalogue, ecosections, cell=50_000):
    """Catalogue segments with a requested name beside each section they meet: GNIS_NAME, seg_id, BLUE_LINE_KEY, eco_id,
    Ecosection. One start per part and all edges take part in the join."""
    names = requests.select(F.col("Stream").alias("GNIS_NAME")).distinct()
    line = F.struct("GNIS_NAME", "seg_id", "BLUE_LINE_KEY").alias("line")
    named = semi_join(catalogue.select(line, "GNIS_NAME", "geom"), names, "GNIS_NAME")
    rings = ring_edges(ecosections.select(F.struct("eco_id", F.col("ECOSECTION_NAME").alias("Ecosection")).alias("eco"), "geom"), ["eco"])
    return lines_in_polygons(named, rings, "line", "eco", cell).select("line.*", "eco.*")


def requested_keys(requests, catalogue, ecosections, cell=50_000, match_section=False, met=None):
    """One stream key per requested name: that of the first catalogue segment that meets a section.

    A name whose first segment has no key finds nothing. `match_section` looks only at the requested section; `met` are
    section_matches that are already there.
    """
    met = section_matches(requests, catalogue, ecosections, cell) if met is None else met
    by = ["GNIS_NAME"]
    if match_section:
        by = ["GNIS_NAME", "Ecosection"]
        met = semi_join(met, requests.select(F.col("Stream").alias("GNIS_NAME"), "Ecosection").distinct(), by)
    first = met.groupBy(*by).agg(F.min(F.struct("seg_id", "BLUE_LINE_KEY")).alias("first"))
    return first.select(*by, F.col("first.BLUE_LINE_KEY").alias("BLUE_LINE_KEY")).where("BLUE_LINE_KEY IS NOT NULL")


def lookup_lines(found, catalogue):
    """Dissolved catalogue lines of the found streams, as distinct edges per (key, name).

    The result of the search is used by several later steps and therefore written to the shared folder.
    """
    keys = found.select(*STREAM).distinct()
    lines = dissolve(inner_join(catalogue, keys, STREAM).select(*STREAM, "geom"), STREAM)
    return materialise(lines, "catalogue_lines")


def lookup_streams(requests, catalogue, ecosections, cell=50_000, repeats=False):
    """Found streams with size and the sections they touch; a repeated request stays a repeated row.

    Requests are counted per name and the rows repeated at the very end. With `repeats` the section list is
    also written once per request of the stream.
    """
    met = materialise(section_matches(requests, catalogue, ecosections, cell), "section_matches")
    found = requested_keys(requests, catalogue, ecosections, cell, met=met)
    times = requests.groupBy(F.col("Stream").alias("GNIS_NAME")).agg(F.count("*").cast("int").alias("times"))
    lines = lookup_lines(found, catalogue)
    # The sections of a stream are those its segments were found to meet, as all of them have the requested name.
    touched = inner_join(met, found, STREAM).select(*STREAM, "eco_id", "Ecosection").distinct()
    sections = text_list(touched, STREAM, {"Ecosections": "Ecosection"}, "eco_id")
    streams = left_join(inner_join(found, times, "GNIS_NAME"), dissolved_size(lines, STREAM), STREAM)
    streams = left_join(streams, sections, STREAM)
    streams = streams.withColumn("Ecosections", F.coalesce("Ecosections", F.lit("NA")))
    first, last = F.lit(1), F.col("times")
    if repeats:
        streams, (first, last) = _dealt(streams), (F.col("__first"), F.col("__last"))
        text = F.concat(F.repeat(F.concat("Ecosections", F.lit(", ")), F.col("times") - 1), "Ecosections")
        streams = streams.withColumn("Ecosections", text)
    return streams.withColumn("request_no", F.explode(F.sequence(first, last))).drop("times", "__first", "__last")


def _dealt(streams, run=RUN_BYTES, task=TASK_BYTES):
    """Runs of requests of each stream, `__first` to `__last`, whose repeated lists take about `run` bytes, dealt out to tasks of
    about `task` bytes. A list per request grows with the square of the requests of a stream, and a stream is one row until then;
    so the number of tasks is that of the bytes to write.
    """
    streams = materialise(streams, "lookup_sizes")
    length = (F.octet_length("Ecosections") + F.lit(2)).cast("double") * F.col("times")
    total = streams.agg(F.sum(length * F.col("times"))).first()[0] or 0
    tasks = max(int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total / task))
    step = F.greatest(F.floor(F.lit(run) / length), F.lit(1)).cast("int")
    firsts = F.explode(F.sequence(F.lit(1), F.col("times"), F.least(step, "times")))
    runs = streams.withColumn("__first", firsts).withColumn("__last", F.least(F.col("__first") + F.least(step, "times") - 1, "times"))
    return runs.repartition(tasks, *STREAM, "__first")


def unmatched_requests(requests, found):
    """Requests whose name was not found."""
    return anti_join(requests, found.select(F.col("GNIS_NAME").alias("Stream")), "Stream")
