from conftest import rows_of

from windrow.operators import scaling


def degenerate(spark):
    nan = float("nan")
    rows = [(5.0, None, nan, 0.0), (5.0, None, 1.0, 5.0), (None, None, 3.0, 10.0), (5.0, None, None, None)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double")


def test_minmax_rules(spark):
    df = degenerate(spark)
    got = rows_of(scaling.minmax(df, ["a", "b", "c", "d"]))
    assert [r[0] for r in got] == [0.0] * 4 and [r[1] for r in got] == [0.0] * 4
    assert got[1][2] == 0.0 and got[2][2] == 1.0 and got[3][2] is None
    assert [r[3] for r in got] == [0.0, 0.5, 1.0, None]


def test_fit_on_one_table_apply_to_another(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    test = spark.createDataFrame([(5.0,), (20.0,)], "x double")
    assert rows_of(scaling.apply_minmax(test, scaling.fit_minmax(train, ["x"]), ["x"])) == [(0.5,), (2.0,)]
    assert rows_of(scaling.apply_zscore(test, scaling.fit_zscore(train, ["x"]), ["x"])) == [(0.0,), (3.0,)]


def test_zscore_of_a_constant_divides_by_one(spark):
    df = spark.createDataFrame([(4.0, 1.0), (4.0, 3.0)], "x double, y double")
    assert rows_of(scaling.zscore(df, ["x", "y"])) == [(0.0, -1.0), (0.0, 1.0)]


def test_statistics_are_one_subquery_and_no_join(spark):
    df = degenerate(spark)
    plan = scaling.minmax(df, ["a", "c", "d"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("scalar-subquery") == 1
