"""Benchmark the headline queries.

Runs each query over $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and forces full execution with the ``noop`` sink (no
collect to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from concord.plans import catalog  # noqa: E402
from concord.session import local_session  # noqa: E402

HEADLINE = [
    "corpus_split",            # unify sources, dedup, deterministic stratified split
    "corpus_source_counts",    # per-source counts and distinct texts
    "avg_weighted",            # sample-size weighted federated averaging
    "uploads_shares",          # upload ingest, content addressing, last write wins
    "rounds_history",          # admission, two-level running-sum barrier, round tracker
    "model_round",             # per-client training step + weighted mean + publish
    "eval_report",             # score corpus with the published model, full report
    "conversation_flags",      # score user turns, flag conversations
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app_name="concord-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    queries = catalog.all_queries()
    # warm-up: JVM, parquet footers, codegen caches
    queries["corpus_grand_total"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
