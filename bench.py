"""Time the headline queries at one scale and print one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores. Every query runs to completion into a sink
that discards rows; building the plan, including its measuring jobs, is part of the time. The
smallest tables, where they lie beside the others, are run through first, so that compiling the
generated code is not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings import QUERIES  # noqa: E402
from windrow.session import local_session  # noqa: E402

HEADLINE = (
    "window_features", "window_features_multi", "window_features_wide", "silver_to_gold",
    "impute_three_step", "ffill_long_series", "minmax_scale", "zscore_scale", "null_audit",
    "summary_percentiles", "parse_delimited", "sequence_assemble", "stratified_split",
    "confusion_long", "overall_metrics", "roc_ovr", "roc_macro", "bootstrap_ci", "mcnemar",
)
FOREST_ROWS = 5447  # about as many rows as the published forest timings use


def forest_cv(spark, folder):
    """Forest of 20 trees, depth 5, 3-fold cross-validation, on 172 window features."""
    from bindings.windows import AXES, ITEM_MEASURES, ITEMS, WIDE, items
    from pyspark.sql import functions as F
    from windrow.ml import training
    from windrow.operators import cleaning, splits, windows
    from windrow.series import measure_columns

    df = items(spark, folder).select(
        "l_suppkey", "l_returnflag", "l_shipdate",
        *[(F.col(c) * f).alias(m) for m, (c, f) in WIDE.items()])
    made = windows.window_features(df, ITEMS, list(WIDE), AXES, least=3, keep_helpers=True)
    columns = measure_columns(made)
    rows = cleaning.drop_incomplete(cleaning.nan_to_zero(made, columns), columns)
    key = ["l_suppkey", "l_returnflag", "window_id"]
    rows = splits.stable_sample(rows, key, FOREST_ROWS / made.count()).persist()
    train = training.with_folds(rows, key)
    n = rows.count()
    started = time.perf_counter()
    training.cross_validator(training.random_forest(trees=(20,)), columns, "l_returnflag", 3,
                             parallelism=3).fit(train)
    seconds = time.perf_counter() - started
    rows.unpersist()
    return seconds, n


def run(spark, folder, name):
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), memory="12g", name="bench")
    QUERIES["row_count"](spark, folder).collect()  # start the engine outside of the timings
    names = sys.argv[1:] or HEADLINE
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in names:
            run(spark, smallest, name)
    seconds = {}
    for name in names:
        started = time.perf_counter()
        run(spark, folder, name)
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        took, rows = forest_cv(spark, folder)
        seconds["forest_cv"] = round(took, 3)
        print("forest_cv", seconds["forest_cv"], rows, "rows", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
