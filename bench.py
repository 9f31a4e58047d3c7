"""Headline-query timings: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed end to end (eager statistics included) and its result
consumed by the no-op sink, so the time is the computation, not the transfer
of result rows to Python."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regloom.plans import registry  # noqa: E402
from regloom.session import ensure_checkpoint_dir, local_session  # noqa: E402

HEADLINE = [
    "m10_metrics_by_run",        # nine metrics per (model, run) over lineitem
    "r1_aggregate_runs",         # run aggregation with exact medians
    "r7_residual_histogram",
    "e2_describe",               # exact quartiles of lineitem numerics
    "e6_correlation_matrix",
    "c16_used_car_clean",        # text parsing / regex / colour map
    "d7_missing_policy",
    "n6_full_preprocess",        # dedupe -> missing -> encode -> scale
    "p1_holdout_split",          # exact-size hash split
    "p2_kfold_assignment",
    "g1_gram_aggregate",         # per-partition NumPy Gram, reduced on the cluster
    "b5_rbf_fit_predict",        # k-means + Gram ridge on the per-order table
    "f8_fcm_network_fit_predict",
    "h9_single_run_metrics",     # flagship pipeline
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    mem = os.environ.get("BENCH_DRIVER_MEMORY", "4g")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          memory=mem)
    ensure_checkpoint_dir(spark)
    # warm-up, not timed: JVM, code generation and Python workers on the smallest tables
    for name in ("m10_metrics_by_run", "g1_gram_aggregate"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode(
            "overwrite").save()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in HEADLINE:
        fn = registry.QUERIES[name]
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(v for v in times.values() if v is not None), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times,
           "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
