"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "flagship_leaderboard", "scorers_by_fold", "metrics_binary", "metrics_multiclass",
    "metrics_regression", "roc_auc", "soft_vote",
    "profile_missing", "target_profile_number", "corr_to_target", "mutual_info_number",
    "category_samples", "task_inference", "profile_report", "row_capped_scan", "hashed_scan",
    "kfold", "stratified_kfold", "time_split", "impute_median", "impute_median_oof", "impute_mode",
    "scale_standard", "scale_standard_oof", "scale_robust", "ordinal_names", "onehot_unseen",
    "target_encode_oof", "binning", "select_f_classif", "ridge_by_fold",
    "format_01", "format_multi_class", "run_improved", "run_memory", "run_mode", "run_policy",
    "extract_code", "truncate_head_tail", "json_metric", "oof_coverage", "baseline_leaderboard",
    "regression_leaderboard", "isotonic", "stacked", "early_stopping", "log_target", "refit_and_score",
    "clusters", "projections", "topic_terms", "run_policy_stream",
]
#: Seconds after which no further query is begun, so that what was timed is printed.
LIMIT = 1200


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("foldwise-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="foldwise-bench-"))
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from foldwise.plans import registry

    # One untimed query starts the JVM's and Python's workers.
    registry.QUERIES["run_policy"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds, failed, skipped, begun = {}, {}, [], time.perf_counter()
    for name in names:
        start = time.perf_counter()
        if start - begun > LIMIT:
            skipped.append(name)
            continue
        try:
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        except Exception as e:  # report it and time the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"{name} failed: {failed[name]}", file=sys.stderr, flush=True)
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line | ({"failed": failed} if failed else {}) | ({"skipped": skipped} if skipped else {})))
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
