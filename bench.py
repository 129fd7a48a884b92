"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print ONE JSON line.  Each query is executed in full into Spark's
``noop`` sink (every row computed, nothing collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "station_identity",        # identity cascade over all trips (M1)
    "trip_history",            # rules + two-role identity join (M2)
    "fct_trip",                # valid trips with date keys (M7)
    "agg_daily_trip_summary",  # flagship (M9)
    "agg_station_activity",    # one-shuffle start/end counts (M10)
    "agg_station_daily",       # one-shuffle station x day rollup (M11)
    "fct_status",              # two dedups + rules + dim join (M3, M8)
    "quarantine_trip",         # rejected trips with stable ids (Q4)
    "check_not_null",          # 37 not-null checks, one pass per table (Q6)
    "feed_events",             # VARIANT feed classification (S8, F2)
    "stream_raw_status",       # Structured Streaming end to end (S5-S7, K6)
    "y7_routes",               # top-k station pairs (Y7)
]


def main() -> None:
    from velotide.registry import QUERIES
    from velotide.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="velotide-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    # inputs are landed before the clock starts; this also warms the JVM
    from velotide.sources.fixtures import _BUILDERS, landed
    t = time.time()
    for name in _BUILDERS:
        landed(spark, sf_dir, name)
    landing = round(time.time() - t, 3)
    times = {}
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "landing_sec": landing, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
