"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up (class loading, code generation, file listing) and once for the figure; the result is written to the
``noop`` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import fixtures  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from checks.session import local_session  # noqa: E402

HEADLINES = [
    "osm_read", "speed_chain", "speed_notebook", "way_segments", "raster_lines", "raster_polygons",
    "raster_speed", "slope", "merge_max", "adjusted_speed", "cost_distance", "reproject_bilinear",
    "reproject_max", "pyramid_nearest", "quantile_breaks", "job_friction_pyramid",
    "job_styled_tiles", "job_presence", "job_cost_distance", "job_adjusted_friction",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    fixtures.elements_orc(spark, sf_dir)
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
            spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "travel_cost_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
