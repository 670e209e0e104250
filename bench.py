"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every figure is the best of three runs after the derived files have been staged; reading the
files is part of the figure, and every result is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripweave.functions import logs as L  # noqa: E402
from tripweave.plans import catalog, kiosk  # noqa: E402
from tripweave.session import build_session  # noqa: E402
from tripweave.sources import tables as T  # noqa: E402

REGISTERED = [
    "flagship_trips_by_district", "csv_inferred", "csv_declared", "sql_on_files", "defect_profile", "copy_count",
    "pivot_hour_rider", "rate_per_rain_class", "top_pairs", "rank_busiest_dock", "monthly_revenue_change",
    "previous_trip_of_vehicle", "word_count", "log_by_kind", "log_top_errors", "log_sequence_check", "rdd_by_kind",
    "graph_degrees", "pagerank", "bfs_path", "weak_components", "stream_tumbling_by_key", "stream_resume",
    "ml_duration_regression",
]


def best(run, times: int = 3) -> float:
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(min(taken), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    here = Path(__file__).resolve().parent
    spark = build_session("tripweave-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__sql__warehouse__dir=str(here / "spark-warehouse"))
    spark.sparkContext.setLogLevel("ERROR")
    for kind in ("trips_csv", "clean", "clean_json", "log", "months"):
        T.staged(spark, sf_dir, kind)
    entries = catalog.entries()
    seconds = {name: best(lambda: entries[name].run(spark, sf_dir).collect()) for name in REGISTERED}

    # the same aggregate from both formats, and parsing with and without a cached result
    def mean_duration(trips, rider, duration):
        return trips.groupBy(rider).agg({duration: "avg"}).collect()

    seconds["csv_group_mean"] = best(lambda: mean_duration(
        spark.read.csv(T.staged(spark, sf_dir, "trips_csv"), header=True, inferSchema=True), "type_usager", "duree_min"))
    seconds["parquet_group_mean"] = best(lambda: mean_duration(
        spark.read.parquet(T.staged(spark, sf_dir, "clean")), "rider_type", "duration_min"))
    seconds["log_parse_count"] = best(lambda: kiosk.events(spark, sf_dir).count())
    cached = L.valid_events(kiosk.parsed(spark, sf_dir)).cache()
    cached.count()
    seconds["log_count_cached"] = best(cached.count)
    cached.unpersist()
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
