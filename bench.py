"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tablewright.plans.catalog import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = [
    "clean_orders", "item_support", "assoc_rules", "mba_topk", "hit_at_k", "user_features", "interactions",
    "als_matrix", "als_topk", "topk_arrays", "usage_compare", "profile_summary", "turn_profile", "trace_tokens",
    "usage_minute", "capacity_ceiling", "cosine_topk", "knn_exact", "retrieve_context", "article_extract",
    "classification_report", "group_fit", "group_predict", "forecast_trend", "frame_sampling", "segment_align",
    "change_feed", "sync_upsert", "payload_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Parquet, codegen and Python workers are started before the clock
    QUERIES["group_fit"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    sf = float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
