import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators import imputation
from windrow.series import SeriesKey

SERIES = SeriesKey(("key", "session"), "i", "tie")


def brute(pdf, limit, directions):
    out = []
    for _, g in pdf.sort_values(["i", "tie"]).groupby(["key", "session"]):
        x = g["x"]
        filled = x.copy()
        for d in directions:
            filled = filled.ffill(limit=limit) if d == "forward" else filled.bfill(limit=limit)
        out.append(g.assign(x=filled))
    return pd.concat(out)


def gaps():
    rows = []

    def series(key, session, pattern):
        i = 0
        for value, times in pattern:
            for _ in range(times):
                rows.append((key, session, i, 0, value))
                i += 1

    n = None
    series(1, "p", [(1.0, 1), (n, 15), (2.0, 1), (n, 16), (3.0, 1), (n, 31), (4.0, 1), (n, 33)])
    series(1, "o", [(n, 20), (7.0, 1), (n, 3)])
    series(2, "p", [(n, 40)])
    return rows


SCHEMA = "key int, session string, i int, tie int, x double"


@pytest.mark.parametrize("rows_per_slice", [10**6, 20, 7])
@pytest.mark.parametrize("directions", [("forward",), ("backward",), ("forward", "backward")])
def test_fill_matches_brute_force(spark, directions, rows_per_slice):
    rows = gaps()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(pd.DataFrame(rows, columns=["key", "session", "i", "tie", "x"]).astype(
        {"x": float}), 15, directions)
    got = imputation.bounded_fill(df, SERIES, ["x"], 15, directions, rows_per_slice).toPandas()
    order = ["key", "session", "i"]
    assert got.columns.tolist() == df.columns
    np.testing.assert_array_equal(got.sort_values(order)["x"].to_numpy(float),
                                  want.sort_values(order)["x"].to_numpy(float))


@pytest.mark.parametrize("rows_per_slice", [10**6, 60])
def test_random_series_with_tied_times_and_two_columns(spark, rows_per_slice):
    rng = np.random.default_rng(5)
    n = 800
    pdf = pd.DataFrame({
        "key": np.where(rng.random(n) < 0.5, 1, rng.integers(2, 6, n)), "session": "s",
        "i": rng.integers(0, 300, n), "tie": np.arange(n),
        "x": np.where(rng.random(n) < 0.2, rng.normal(size=n), np.nan),
        "y": np.where(rng.random(n) < 0.1, rng.normal(size=n), np.nan)})
    df = spark.createDataFrame(pdf, "key int, session string, i int, tie int, x double, y double")
    df = df.select("key", "session", "i", "tie", *[
        F.when(~F.isnan(c), F.col(c)).alias(c) for c in "xy"])
    got = imputation.bounded_fill(df, SERIES, ["x", "y"], 3, rows_per_slice=rows_per_slice).toPandas()
    got = got.sort_values("tie")
    for c in "xy":
        want = brute(pdf.assign(x=pdf[c]), 3, ("forward", "backward")).sort_values("tie")["x"]
        np.testing.assert_array_equal(got[c].to_numpy(float), want.to_numpy(float))


def test_fill_keeps_readings_and_stays_within_the_limit(spark):
    got = {(r.key, r.session, r.i): r.x for r in imputation.bounded_fill(
        spark.createDataFrame(gaps(), SCHEMA), SERIES, ["x"], 15).collect()}
    assert all(got[k, s, i] == x for k, s, i, _, x in gaps() if x is not None)
    # 31 missing: 15 from before, 15 from behind, one out of reach
    assert (got[1, "p", 48], got[1, "p", 49], got[1, "p", 50]) == (3.0, None, 4.0)
    assert got[1, "p", 80] == 4.0 and got[1, "p", 81] is None
    assert all(got[2, "p", i] is None for i in range(40))


def test_mean_of_the_filled_column_per_subject(spark):
    rows = [(1, "a", 0, 0, 2.0), (1, "a", 1, 0, float("nan")), (1, "a", 2, 0, None),
            (1, "b", 0, 0, None), (2, "a", 0, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.key, r.session, r.i): r.x
           for r in imputation.impute(df, SERIES, ["x"], 1, ["key"]).collect()}
    assert got == {(1, "a", 0): 2.0, (1, "a", 1): 2.0, (1, "a", 2): 2.0, (1, "b", 0): 2.0,
                   (2, "a", 0): None}


def test_group_means_on_rows_keep_a_null_key(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (None, 5.0)], "k int, x double")
    got = rows_of(imputation.with_group_means(df, ["k"], ["x"]))
    assert sorted(got, key=str) == [(1, 1.0, 2.0), (1, 3.0, 2.0), (None, 5.0, 5.0)]
