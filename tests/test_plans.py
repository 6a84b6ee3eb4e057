"""What the physical plans are made of."""

import pytest
from pyspark.sql import functions as F

from bindings import QUERIES
from windrow.operators import cleaning, windows
from windrow.operators.windows import WindowSpec

MODEL_QUERIES = {"model_suite", "svm_suite", "predict_lr", "topk_importance", "scaling_run",
                 "weak_scaling_run", "seed_stability"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_shuffles_partial_aggregates_only(spark, tiny):
    df = spark.read.parquet(f"{tiny}/events.parquet")
    text = plan(windows.window_features(df, WindowSpec(("user_id",), "ts", 3600.0), ["value"]))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    assert "Window" not in text
    # the origins are aggregated once, before; one exchange for the windows
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, tiny):
    df = spark.read.parquet(f"{tiny}/lineitem.parquet")
    text = plan(cleaning.drop_label(df, "l_returnflag", "R").select("l_returnflag", "l_tax"))
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))]" in text
    assert "ReadSchema: struct<l_tax:double,l_returnflag:string>" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_query_runs_python_per_row_or_joins_crosswise(spark, tiny, name):
    text = plan(QUERIES[name](spark, tiny))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_wide_aggregate_is_in_compiled_sets_joined_without_a_shuffle(spark, tiny):
    df = spark.read.parquet(f"{tiny}/lineitem.parquet").select(
        "l_suppkey", "l_shipdate", *[(F.col("l_quantity") * i).alias(f"m{i}") for i in range(40)])
    spec = WindowSpec(("l_suppkey",), "l_shipdate", 86_400.0 * 90)
    made = windows.window_features(df, spec, [f"m{i}" for i in range(40)])
    text = plan(made)
    # one exchange for each of four sets, and none between them
    assert text.count("Exchange hashpartitioning(_key") == text.count("Exchange hashpartitioning") == 4
    assert made.columns[1:3] == ["m0_mean", "m0_std"] and len(made.columns) == 161


def test_curves_read_the_predictions_once(spark, tiny):
    from windrow.operators import roc
    df = spark.read.parquet(f"{tiny}/embeddings.parquet").select(
        "label", F.slice("embedding", 1, 4).alias("scores"))
    report = roc.roc_report(roc.cumulative_counts(roc.one_vs_rest(df, "label", "scores")))
    assert "FileScan" not in plan(report) and "posexplode" not in plan(report).lower()
