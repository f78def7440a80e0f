"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query runs
BENCH_RUNS times (three) into a noop sink; the median counts, so the first, cold run does not.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from freshet.queries import registry  # noqa: E402
from freshet.session import build_session  # noqa: E402

HEADLINE = [
    "seg_max_sensitivity",
    "segment_preparation",
    "name_repair",
    "repaired_segments",
    "add_count",
    "crossing_within_50m",
    "species_overlay",
    "region_overlay",
    "polygon_overlay",
    "expert_overlay",
    "species_richness",
    "drought_risk",
    "harmonized_risk",
    "priority_rating",
    "lookup_streams",
    "longer_than_gate",
    "dissolve_counts",
    "line_length",
    "reproject_points",
    "simplify_by_share",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("freshet-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry(), {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
