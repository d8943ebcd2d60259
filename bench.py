"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line. Each query is executed completely with the
``noop`` sink (no collect), after one warm-up query for JVM start-up."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_class_pivot", "class_balance", "feature_label_correlation", "amount_histogram",
    "engineered_features", "stratified_split", "batch_running_totals", "recent_alerts",
    "band_edges", "graph_propagation", "model_comparison", "classification_report",
    "ensemble_features", "isolation_forest_scores", "reconstruction_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from txnlens.plans.catalog import load_all
    from txnlens.session import get_spark

    spark = get_spark("txnlens-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    reg["positive_rate"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
