import math

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.functions import (
    bracket_number, chi2_tail, digits_of, hash_fraction, micros, nan_to, normal_quantile,
    null_if_nan, nullify_nan, poisson_pmf, present, ratio_or, ratio_or_zero,
    window_index,
)


def test_hash_fraction_ignores_partitions_and_is_even(spark):
    df = spark.range(20_000).select("id", hash_fraction("id").alias("h"))
    one = dict(rows_of(df.repartition(1)))
    assert one == dict(rows_of(df.repartition(7)))
    assert all(0 <= h < 1 for h in one.values())
    assert abs(sum(h < 0.3 for h in one.values()) / 20_000 - 0.3) < 0.02
    other = dict(rows_of(spark.range(20_000).select("id", hash_fraction("id", seed=1))))
    assert other != one


def test_micros_reads_every_kind_of_time(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:01.5' AS n, "
                   "TIMESTAMP'2024-01-01 00:00:01.5' AS t, 1.5D AS d, 1500000L AS l, 'x' AS s")
    start = 1704067200_000000
    got = df.select(*[micros(df, c).alias(c) for c in "ntdl"]).first()
    assert tuple(got) == (start + 1_500_000, start + 1_500_000, 1_500_000, 1_500_000)
    with pytest.raises(TypeError):
        micros(df, "s")


def test_micros_of_wall_clock_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 00:00:00' AS n")
        assert df.select(micros(df, "n")).first()[0] == 1719792000_000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_index_is_exact_where_doubles_are_not(spark):
    df = spark.range(1000).select(F.round(5.12 + F.col("id") * 0.01, 2).alias("t"))
    exact = df.select(window_index(micros(df, "t"), F.lit(5_120_000), 5_000_000).alias("w"))
    assert sorted(rows_of(exact.groupBy("w").count())) == [(0, 500), (1, 500)]
    floats = df.select(F.floor((F.col("t") - 5.12) / 5.0).alias("w")).groupBy("w").count()
    assert sorted(rows_of(floats)) != [(0, 500), (1, 500)]


def test_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    x = F.col("x")
    got = df.select(null_if_nan(x), nan_to(x), present(x)).collect()
    assert [tuple(r) for r in got] == [(1.0, 1.0, True), (None, 0.0, False), (None, None, False)]
    assert rows_of(nullify_nan(df)) == [(1.0,), (None,), (None,)]


def test_text_keys(spark):
    df = spark.createDataFrame([("local[4]", "subject101.dat"), ("local[*]", "none")], "a string, b string")
    got = df.select(bracket_number(F.col("a")), digits_of(F.col("b"), r"subject(\d+)"))
    assert rows_of(got) == [(4, 101), (None, None)]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a int, b int")
    got = df.select(ratio_or_zero(F.col("a"), F.col("b")), ratio_or(F.col("a"), F.col("b"), None))
    assert rows_of(got) == [(0.5, 0.5), (0.0, None)]


def test_tails_and_quantiles(spark):
    xs = [0.0, 0.1, 1.0, 3.841459, 10.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for (x, p) in rows_of(df.select("x", chi2_tail(F.col("x")))):
        assert abs(p - math.erfc(math.sqrt(x / 2))) < 2e-7
    ps = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.9, 0.975, 0.9999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for (p, z) in rows_of(df.select("p", normal_quantile(F.col("p")))):
        assert abs(0.5 * math.erfc(-z / math.sqrt(2)) - p) < 1e-8 * max(1, p)


def test_poisson_pmf(spark):
    cases = [(k, m) for m in (0.5, 3.0, 30.0, 400.0) for k in (0, 1, 2, 14, 15, 16, 17, 40, 390)]
    df = spark.createDataFrame(cases, "k long, m double")
    for k, m, got in rows_of(df.select("k", "m", poisson_pmf(F.col("k"), F.col("m")))):
        want = math.exp(k * math.log(m) - m - math.lgamma(k + 1))
        assert math.isclose(got, want, rel_tol=1e-11), (k, m)
