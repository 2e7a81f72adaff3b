"""Benchmark the headline queries and print one JSON line.

Environment:
  BENCH_SF_DIR  data directory (default /root/testdata/sf0.1)
  BENCH_CPUS    local cores (default 8)

Each query is built from the raw tables (fixture derivation included) and
fully executed with a ``noop`` write, so nothing is collected to the driver.
A warm-up pass on the smallest data set compiles the code paths first; it
does not touch the benchmarked data.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortflow.plans import catalog  # noqa: E402
from cohortflow.plans.sizing import checkpoint_dir  # noqa: E402
from cohortflow.session import build_session  # noqa: E402

HEADLINE = [
    ("expand_count", "count_in_window"),     # D2 + D3: person x rule expansion, windowed count
    ("allocate", "allocate_doses"),          # D5 + D6: stage collapse and dose allocation
    ("series", "caveat_flags"),              # D8 + D9: dose sequence and caveat flags
    ("product_status", "mmr_recheck"),       # D10-D12: overrides and product status
    ("full_report", "full_report"),          # D1-D21: the wide report
]
WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(spark):
        # Local run: the session names no shared folder, so use a scratch one.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortflow-ckpt-"))
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(WARMUP_DIR) != os.path.abspath(sf_dir):
        for _, q in HEADLINE:
            run(spark, q, WARMUP_DIR)
    times = {key: round(run(spark, q, sf_dir), 3) for key, q in HEADLINE}
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
