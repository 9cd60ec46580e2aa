"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names
separated by commas, default the headline list, ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["bulk_load_sources", "associate_within_field", "associate_small_radius", "associate_dense_field", "sky_join_all_pairs", "object_statistics", "prune_not_best_merges",
            "prune_not_best_sources", "associate_across_fields", "point_to_tile", "batch_cone_search", "overlapping_images",
            "nest_lightcurves", "assemble_alerts", "pixel_clipped_stats", "resolve_vbest", "drop_overruns", "count_merges_by_field"]


def main() -> None:
    from skycat.plans.queries import QUERIES
    from skycat.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
