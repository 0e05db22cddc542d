"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8), materialising the full result through
the ``noop`` sink (every column computed, nothing collected), and prints
one JSON line: {"metric", "value", "unit", "queries", "sf", "warmup_dir"}.
An untimed warm-up pass over the same queries at sf0.01 runs first
(``BENCH_WARMUP=0`` turns it off and times cold runs).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "weibull_fit", "cumulative_hazard", "weibull_points", "weibull_segmented_fit", "rank_average_desc",
    "mean_median", "dense_row_index", "tfidf", "tokenize_content_words", "clean_reviews",
    "classification_report", "fixed_chunks", "recursive_chunks", "html_element_text",
    "similarity_search", "sft_tokenize", "csv_export", "log_histogram", "grouped_bar_table",
    "similarity_search_cosine", "retrieval_compare", "collate_batches", "collection_store", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("kestrel-bench")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from kestrel.plans import all_plans
    from kestrel.session import checkpoint_root, release_cached

    checkpoint_root(spark)
    plans = all_plans()
    # warm-up: one untimed pass of the same queries on the sf0.01 tables
    # (JVM class loading and JIT of the hot loops, codegen, Python worker
    # start-up), so the timed pass measures steady-state query time
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    queries = only or HEADLINE
    if os.path.isdir(warm_dir) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for w in queries:
            plans[w].fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
            release_cached()

    times: dict[str, float] = {}
    for name in queries:
        t0 = time.perf_counter()
        df = plans[name].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_cached()
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "warmup_dir": warm_dir if os.environ.get("BENCH_WARMUP", "1") == "1" else None}))
    spark.stop()


if __name__ == "__main__":
    main()
