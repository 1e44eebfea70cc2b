"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from airq.queries import QUERIES
from airq.session import local_session

HEADLINE = [
    "sensor_coverage",
    "schema_union",
    "calendar_struct",
    "geohash_encode",
    "hourly_mean",
    "geo_time_aggregate",
    "gap_fill",
    "pivot_mean",
    "unpivot_long",
    "weather_join_5key",
    "inner_dim_join",
    "nearest_station_by_capability",
    "nearest_by_geohash_prefix",
    "location_wide",
    "mse_to_reference",
    "series_build",
    "tile_series",
    "rank_first_five",
    "first_seen_order",
    "describe_value",
    "kpi_native_all",
    "kpi_fitted_all",
    "feature_table",
    "mutual_information",
    "boosted_regression",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session(cpus, spark__ui__showConsoleProgress="false")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum of warm query times", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
