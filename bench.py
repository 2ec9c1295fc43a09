"""Headline timings, one JSON line.

Queries run in order and share prepared tables, so each timing is the cost the
query adds: the first one that needs a table pays for building it.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from wayfleet.plans import registry
from wayfleet.session import build_session

HEADLINES = [
    "road_edges", "components", "matched_pings", "nearest_nodes", "edge_speed", "edge_state", "latest_edge_state",
    "blocked_edges", "latest_positions", "conflated_positions", "edge_occupancy", "seed_routes", "normalized_vehicles",
    "traffic_snapshot", "reroute_candidates", "snapshot_speed", "route_fitness", "exact_order", "ga_order",
    "edge_costs", "shortest_path_cost", "route_from_position", "optimize_vehicles", "merged_routes", "route_geometry", "route_segments", "route_progress",
    "heat_points", "upserted_vehicles", "streamed_edge_state", "streamed_archive",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINES:
        began = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
