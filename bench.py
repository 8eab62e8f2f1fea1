"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once as warm-up and then once timed, writing all rows to a null sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from valora.catalogue import QUERIES  # noqa: E402
from valora.session import get_session  # noqa: E402

HEADLINE = [
    "rate_leaders", "multi_club_rollup", "per90_rates", "pct_rank_avg", "season_delta", "asof_nearest", "asof_backward",
    "team_quality", "stage_features", "resolve_cascade", "exact_match", "or_semi_filter", "normalize_text", "json_explode",
    "paged_scan", "regression_metrics", "spearman_rank", "group_stats", "corr_matrix", "histogram", "fee_benchmark",
    "undervalued", "lookup_verdict", "ridge_fit", "scored_values", "shap_importance", "joined_dataset", "value_history", "forest_fit", "gbt_fit",
    "forest_stump", "boosting_stump", "shap_additivity",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = get_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
                        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run(spark, name, sf_dir)
        timings[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
