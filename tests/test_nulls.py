"""Null keys, null classes, times that are no number and columns without a value."""

from __future__ import annotations

from pyspark.sql import functions as F

from windrow.functions.clock import micros
from windrow.operators import quality, splits
from windrow.operators.windows import WindowSpec, assign_windows, keep_complete, keep_complete_spread


def test_windows_of_a_null_key_are_kept(spark):
    rows = [(k, float(i) / 10) for k in ("a", None) for i in range(20)] + [("b", 0.0)]
    spec = WindowSpec(("k",), "t", 1.0)
    windowed = assign_windows(spark.createDataFrame(rows, "k string, t double"), spec)
    for keep in (keep_complete, keep_complete_spread):
        kept = keep(windowed, spec, 10).groupBy("k").count().collect()
        assert {r["k"]: r["count"] for r in kept} == {"a": 20, None: 20}


def test_null_is_a_class_of_the_stratified_split(spark):
    rows = [(i, None if i % 2 else "x") for i in range(100)]
    marked = splits.mark_stratified(spark.createDataFrame(rows, "id int, label string"), "label", "id")
    assert {r["label"]: r["n"] for r in marked.groupBy("label").agg(
        F.sum(F.col("in_train").cast("int")).alias("n")).collect()} == {None: 40, "x": 40}


def test_a_time_that_is_no_number_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "t double")
    assert [r[0] for r in df.select(micros(df, "t")).collect()] == [None, 1_500_000, None]


def test_percentiles_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {(r["measure"], r["share"]): r["value"]
           for r in quality.exact_percentiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {("a", 0.5): 2.0, ("b", 0.5): None}
