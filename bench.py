"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is timed end to end (plan + execute + collect of its result,
which is small: runs, reports, statistics). The index build is timed on its own
(tokenise, write postings, derive statistics); later queries reuse it, as a
deployment would.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "rank_jm", "rank_dirichlet", "rank_bm25", "rank_boolean", "total_hits",
    "metrics", "eval_report", "tuning_matrix", "test_report", "wilcoxon_pvalue",
    "dedup_exact", "top_terms", "phrase",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ["BENCH_CPUS"] = cpus
    from quire.plans.indexes import corpus_index
    from quire.plans.registry import QUERIES, load_all
    from quire.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * int(cpus)),
                      app_name="quire-bench")
    load_all()
    times: dict[str, float] = {}
    t0 = time.time()
    corpus_index(spark, sf_dir, "standard")
    times["index_build"] = round(time.time() - t0, 3)
    t0 = time.time()
    corpus_index(spark, sf_dir, "shingle2")          # phrase index
    times["index_build_shingles"] = round(time.time() - t0, 3)
    failed: dict[str, str] = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).collect()
        except Exception as e:  # noqa: BLE001 -- report, keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "total_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
