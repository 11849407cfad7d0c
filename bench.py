"""Benchmark the headline queries.

Runs each query of HEADLINE at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``: one warm-up, then the
median of ``$BENCH_REPEATS`` (default 3) timed runs, each written to the
``noop`` sink.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("clean_v2", "clean_v1", "upsert_latest_by_link", "star_load", "crawl_frontier", "html_to_text")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in sys.argv[1:] if q in HEADLINE] or list(HEADLINE)

    from jobsift.registry import QUERIES, load_all
    from jobsift.session import get_session

    load_all()
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in only:
        build = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(repeats)), 3)
        rows[name] = build(spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows": rows, "sf": sf, "cpus": int(cpus), "repeats": repeats}))


if __name__ == "__main__":
    main()
