"""One key holds a third of the rows: results stay whole and no task receives that key alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.operators import imputation, joins, ordering, roc
from windrow.operators.ordering import cut_points, slice_of
from windrow.series import SeriesKey

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return spark.range(N).select(
        "id", key.cast("int").alias("key"), (F.col("id") * 1000).alias("t"),
        F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("x"))


def test_slices_are_even_for_the_table_and_bound_the_hot_key(skewed):
    df = skewed.withColumn("d", F.col("t").cast("double"))
    cuts, size = cut_points(df, "d", 500)
    assert len(cuts) == 11 and size == 500
    sizes = [r["count"] for r in slice_of(df, "d", cuts, "s").groupBy("s").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1.3 * size


def test_slices_grow_with_the_table_only_in_number(skewed):
    cuts, size = cut_points(skewed.withColumn("d", F.col("t").cast("double")), "d", 10)
    assert len(cuts) == 599 and size == 10


@pytest.mark.parametrize("sampled", [False, True])
def test_rows_of_one_instant_are_cut(spark, monkeypatch, sampled):
    """20,000 rows of one series at one instant, and some around it."""
    if sampled:
        monkeypatch.setattr(ordering, "SAMPLE_PER_SLICE", 400)
    time = F.when(F.col("id") < 500, 1).when(F.col("id") < 20_500, 2).otherwise(3)
    df = spark.range(21_000).select(
        F.lit(1).alias("key"), time.cast("long").alias("t"), F.concat(
            F.lit("r"), F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("tie"), "id",
        F.when(F.col("id") % 9 == 0, F.col("id").cast("double")).alias("x")).repartition(5)
    series = SeriesKey("key", "t", "tie")
    timed = imputation.with_position(df, series)
    cuts = ordering.boundaries(timed, "_us", ["t", "tie"], 500)
    cut = ordering.slice_between(timed, "_us", ["t", "tie"], cuts, "s")
    sizes = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert sum(sizes) == 21_000 and max(sizes) <= 500
    order = [r["s"] for r in cut.orderBy("t", "tie").collect()]
    assert order == sorted(order)
    whole = imputation.bounded_fill(df, series, ["x"], 5)
    made = imputation.bounded_fill(df, series, ["x"], 5, rows_per_slice=500)
    assert whole.exceptAll(made).count() == 0 and made.count() == 21_000


def test_many_slices_are_cut_by_position(spark):
    """Where slices are many, no row is compared with a list of all boundaries of its instant."""
    df = spark.range(6_000).select(
        F.when(F.col("id") % 50 > 0, 1).alias("key"),
        F.when(F.col("id") % 900 > 0, F.floor(F.col("id") / 5_000)).alias("t"),
        F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("tie"), "id",
        F.when(F.col("id") % 9 == 0, F.col("id").cast("double")).alias("x")).repartition(5)
    series = SeriesKey("key", "t", "tie")
    cut = ordering.in_slices(imputation.with_position(df, series), "_us", ["t", "tie"], 7, "s")
    assert max(r["count"] for r in cut.groupBy("s").count().collect()) <= 7
    order = [r["s"] for r in cut.orderBy("t", "tie").collect()]
    assert order == sorted(order)
    whole = imputation.bounded_fill(df, series, ["x"], 5)
    made = imputation.bounded_fill(df, series, ["x"], 5, rows_per_slice=7)
    assert "_ties" not in made._jdf.queryExecution().toString()
    assert whole.exceptAll(made).count() == 0 and made.count() == 6_000


def test_fill_with_missing_times_and_nan(spark):
    rows = [(1, [None, float("nan"), 1.0, 1.0000001, 1.0000002][i % 5], 997 * i % 1000, i,
             float(i) if i % 4 == 0 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "key int, t double, tie int, id int, x double")
    series = SeriesKey("key", "t", "tie")
    whole = imputation.bounded_fill(df, series, ["x"], 3)
    assert whole.exceptAll(imputation.bounded_fill(df, series, ["x"], 3, rows_per_slice=60)).count() == 0


def test_fill_of_a_hot_series(skewed):
    series = SeriesKey("key", "t", "id")
    whole = imputation.bounded_fill(skewed, series, ["x"], 4)
    cut = imputation.bounded_fill(skewed, series, ["x"], 4, rows_per_slice=300)
    assert whole.exceptAll(cut).count() == 0 and cut.count() == N


def test_fill_of_a_hot_series_without_a_key(skewed):
    series = SeriesKey("key", "t", "id")
    keyless = skewed.withColumn("key", F.when(F.col("key") != 0, F.col("key")))
    whole = imputation.bounded_fill(keyless, series, ["x"], 4)
    cut = imputation.bounded_fill(keyless, series, ["x"], 4, rows_per_slice=300)
    assert whole.exceptAll(cut).count() == 0 and cut.count() == N


def test_cuts_from_a_sample_still_give_even_slices(skewed, monkeypatch):
    monkeypatch.setattr(ordering, "SAMPLE_PER_SLICE", 100)
    df = skewed.withColumn("d", F.col("t").cast("double"))
    cuts, _ = cut_points(df, "d", 1000)
    sizes = [r["count"] for r in slice_of(df, "d", cuts, "s").groupBy("s").count().collect()]
    assert len(cuts) == 5 and sum(sizes) == N and max(sizes) < 2000


def test_hot_rows_are_spread(spark):
    """A key with half of the rows goes evenly to as many pieces as it fills parts."""
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(
        F.col("id") % 5000).cast("int").alias("key"))
    table = rows.groupBy("key").agg(F.min("id").alias("t0")).withColumn("key", F.col("key").cast("long"))
    assert list(joins.hot_keys(rows, ["key"], parts=16).values()) == [8]
    joined = joins.spread_join(rows, table, ["key"], "left", ["id"], parts=16)
    assert joined.count() == 40_000 and joined.filter("t0 IS NULL").count() == 0
    own = joined.select("key", spark_key(joined).alias("piece")).filter("key = 0")
    sizes = [r["count"] for r in own.groupBy("piece").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * 20_000 / 8


def spark_key(joined):
    """The piece a row of the hot key was dealt to."""
    return F.pmod(F.xxhash64("id"), F.lit(8))


def test_scores_of_one_class_are_summed_in_slices(spark):
    rng = np.random.default_rng(4)
    hit = rng.random(N) < 0.3
    score = rng.random(N)
    long = spark.createDataFrame(
        [(0 if i % 3 else 1, float(s), bool(h)) for i, (s, h) in enumerate(zip(score, hit))],
        "class int, score double, hit boolean")
    whole = roc.cumulative_counts(long)
    cut = roc.cumulative_counts(long, rows_per_slice=250)
    assert whole.exceptAll(cut).count() == 0 and cut.count() == N
