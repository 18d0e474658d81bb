"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose data and cores. Each
query runs once to warm up and is then timed; a query's time covers planning and execution.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyweave.bindings.queries import QUERIES
from skyweave.session import build_session

HEADLINE = [
    "mart_traffic_density", "mart_fleet_utilisation", "mart_route_efficiency", "mart_weather_risk",
    "mart_network_disruption", "mart_safety_event", "mart_punctuality_proxy", "mart_launch_conflict",
    "mart_launch_slips", "mart_orbital_decay", "mart_fleet_identity", "mart_fuel_exposure", "mart_notam_impact",
    "segment_fixes", "flight_legs", "nearest_airport", "aircraft_dimension", "dedupe_keep_last", "parse_positions",
    "parse_metar", "parse_disruption", "parse_registry", "replay_rebuild", "upsert_merge", "dq_suite_position",
    "hazard_exposure", "leg_identity_asof", "stream_density",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(timed(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
