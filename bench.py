"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
cores. Every result is computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from brightloom import plans
from brightloom.session import local_session

HEADLINE = [
    "retail_clean_sales", "retail_line_no", "retail_sales_by_category", "retail_top_products", "upsert_fact",
    "dq_missing_profile", "dq_conflicting_keys", "dq_iqr_outliers", "dq_warehouse_suite",
    "ts_resample_interpolate", "flood_feature_matrix",
    "npi_score", "npi_rankings",
    "churn_clean_charges", "churn_roi_sweep", "ml_roc_auc", "ml_average_precision", "ml_confusion_metrics", "drift_psi",
    "geo_knn", "geo_moran_global",
    "cv_training_dedupe", "cv_project_order", "text_normalize_name",
    "mart_fct_orders", "mart_scd2", "saas_mrr_bridge", "saas_cohort_retention", "fc_backtest_wape",
    "rag_chunks", "rag_topk", "stream_funnel_tumbling",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(100_000).repartition(8).groupBy().count().collect()  # start the workers
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
