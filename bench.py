"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortix.catalog.queries import all_queries  # noqa: E402
from cohortix.session import build_session  # noqa: E402

HEADLINE = (
    "quality_profile", "cleaning_audit", "learn_fences", "cap_ratio_tail", "feature_matrix",
    "cluster_profile_named", "mixture_assign", "mixture_loglik_bic", "em_step", "silhouette_euclidean",
    "metric_suite", "threshold_grid", "curve_decimate_roc", "multiclass_summary",
    "stratified_split", "holdout_assign", "holdout_balance", "segment_summary", "score_batch",
    "kmeans_fit", "gmm_fit", "k_sweep", "churn_fit_select", "churn_cv", "surrogate_fit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["tenure_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
