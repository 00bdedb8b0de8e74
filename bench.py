"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from panelforge import build_session
from panelforge.catalog import QUERIES

HEADLINE = (
    "hourly_mean", "edge_hourly_mean", "net_flow", "inner_join_chain", "stress_score",
    "partition_percentile", "trailing_avg_25_raw", "lag_features", "ffill_bfill",
    "impute_method_mae", "impute_apply_best", "clean_features", "model_matrix",
    "target_correlation", "threshold_sweep", "scenario_scores", "partition_replace",
    "nearest_reference", "grid_flatten", "arima_fit", "batch_preparation",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_sql"](spark, sf_dir).collect()   # start the engine
    times: dict[str, float] = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
