"""Percentiles by narrowing ranks against numpy, and sketches against exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.operators import quantiles

SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def wide(spark, columns, n=3000):
    """Spread, tied, constant, heavy-tailed and holed columns, over and over."""
    rng = np.random.default_rng(8)
    made = [rng.normal(size=n), rng.integers(0, 3, n).astype(float), np.full(n, 7.0),
            10.0 ** rng.uniform(-200, 200, n), np.where(rng.random(n) < 0.4, -0.0, rng.normal(size=n)),
            np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n))]
    names = [f"c{i}" for i in range(columns)]
    rows = [[float(made[i % 6][r]) for i in range(columns)] for r in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(
        4).persist(), names, made


@pytest.mark.parametrize("gathered", [None, 50])
def test_percentiles_of_many_columns_take_as_many_scans_as_of_few(spark, gathered):
    jobs = {}
    for columns in (6, 40):
        df, names, made = wide(spark, columns)
        df.count()
        spark.sparkContext.setJobGroup(f"columns-{columns}-{gathered}", "")
        got = quantiles.exact_percentiles(df, names, SHARES, gathered)
        spark.sparkContext.setJobGroup("rest", "")
        jobs[columns] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(
            f"columns-{columns}-{gathered}"))
        for r in got.collect():
            values = made[int(r["measure"][1:]) % 6]
            want = np.quantile(values[~np.isnan(values)], r["share"])
            assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-12), r
        df.unpersist()
    assert jobs[6] == jobs[40]


def test_sketches_of_groups_add_up(spark):
    rng = np.random.default_rng(9)
    rows = [(i % 9, float(x), None if i % 2 else float(i)) for i, x in enumerate(rng.normal(size=20000))]
    rows += [(99, None, None), (None, float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "day int, a double, b double").persist()
    parts = quantiles.sketches(df, ["a", "b"], ["day"])
    assert parts.count() == 22
    whole = quantiles.sketched_percentiles(quantiles.merged(parts), SHARES).collect()
    values = {"a": np.sort([r[1] for r in rows[:20000]]),
              "b": np.sort([r[2] for r in rows if r[2] is not None])}
    assert len(whole) == 2 * len(SHARES)
    for r in whole:
        v = values[r["measure"]]
        assert (r["n"], r["least"], r["greatest"]) == (len(v), v[0], v[-1])
        assert r["n_missing"] == 20002 - len(v)
        assert abs(np.searchsorted(v, r["value"]) / len(v) - r["share"]) < 0.02
    empty = quantiles.sketched_percentiles(parts.filter("day = 99"), [0.5]).collect()
    assert [(r["n"], r["value"]) for r in empty] == [(0, None)] * 2
    assert quantiles.exact_percentiles(df.filter("day = 99"), ["a"], [0.5]).first()["value"] is None
