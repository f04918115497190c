"""Benchmark the headline pipelines.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS], executing the whole plan into Spark's no-op sink (every
row is produced, nothing is collected).  Plan building is timed too: it
includes the size checks behind each broadcast and the pivot-value lookup.
$BENCH_WARMUP passes over all queries warm the JVM (code generation and JIT
settle over several runs), then $BENCH_RUNS timed passes; each query's
median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["score_answers", "paper_totals", "question_detail", "wide_scores",
            "wide_scores_strict", "wide_scores_pivot_join"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from scorekeep.queries import QUERIES
    from scorekeep.session import build_session
    spark = build_session("scorekeep-bench", master=f"local[{cpus}]",
                          # sf0.1 shuffles are small: one partition per core
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          extra={"spark.driver.memory": "8g"})

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for _ in range(warmup):
        for name in names:
            once(name)
    times = {name: [] for name in names}
    for _ in range(runs):
        for name in names:
            times[name].append(once(name))
    results = {name: round(statistics.median(t), 3) for name, t in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "median_wall_time_sum", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus,
                      "runs": runs, "warmup_passes": warmup}))
    spark.stop()


if __name__ == "__main__":
    main()
