"""Time the headline queries and print one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.catalog import all_queries  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = (
    "exact_duplicates",
    "fuzzy_duplicates",
    "substring_dedup",
    "language_id",
    "extract_html",
    "quality_bucket_counts",
    "thresholds",
    "repetition_filter",
    "pii_redact",
    "tokenize_regex",
    "token_stats",
    "index_layout",
    "join_segments",
    "loss_mask",
    "pack_first_fit_decreasing",
    "materialize_bins",
    "fraction_split",
    "holdout_split",
    "group_advantage",
    "resolve_placeholders",
    "knn_cosine",
    "chunk_documents",
    "page_markdown",
    "prepare_numeric",
    "train_test_split_stratified",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = all_queries()
    # Start the JVM's and the Python workers' one-time work before the clock runs.
    spark.range(64).repartition(8).mapInPandas(lambda it: it, "id long").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
