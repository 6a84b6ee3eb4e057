import pytest
from conftest import rows_of

from windrow.operators import reports

RUNS = [("local[1]", 0.5, 10, 8, 8.0, .9, .9), ("local[4]", 0.5, 10, 8, 2.0, .9, .9),
        ("local[2]", 1.0, 20, 16, 6.0, .9, .9), ("local[4]", 1.0, 20, 16, 0.0, .9, .9)]
SCHEMA = ("cores string, fraction double, rows int, train_rows int, train_sec double, "
          "accuracy double, f1_weighted double")


def test_strong_speedup_falls_back_to_own_time(spark):
    got = reports.strong_speedup(spark.createDataFrame(RUNS, SCHEMA))
    assert {(r.cores, r.fraction): r.speedup for r in got.collect()} == {
        ("local[1]", 0.5): 1.0, ("local[4]", 0.5): 4.0, ("local[2]", 1.0): 1.0, ("local[4]", 1.0): 0.0}


def test_weak_efficiency_is_measured_from_the_smallest_run(spark):
    got = reports.weak_efficiency(spark.createDataFrame(RUNS[:3], SCHEMA))
    assert {r.cores: r.efficiency for r in got.collect() if r.fraction == 0.5 or r.cores == "local[2]"} == {
        "local[1]": 1.0, "local[4]": 4.0, "local[2]": 1.33}
    both = reports.scaling_table(spark.createDataFrame(RUNS, SCHEMA), spark.createDataFrame(RUNS[:2], SCHEMA))
    assert both.columns == list(reports.SCALING_COLUMNS) and both.count() == 6


def test_run_statistics(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.9)], "run int, accuracy double")
    r = reports.run_statistics(df, ["accuracy"]).first()
    assert list(r)[1:] == pytest.approx([3, 0.7, 0.2, 0.5, 0.9, 0.4])


def test_best_row_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, f1 double")
    assert reports.best_row(df, "f1", "model").first().model == "a"
    assert [r.model for r in reports.top_rows(df, "f1", "model", 2).collect()] == ["a", "b"]


def test_comparison_aligns_sources_and_joins_devices(spark):
    one = spark.createDataFrame([("m", 0.5)], "model string, accuracy double")
    two = spark.createDataFrame([("n", "CUDA 1", 0.7, 3.0), ("o", "laptop", None, 1.0)],
                                "model string, hardware string, accuracy double, training_time_s double")
    devices = spark.createDataFrame([("cuda", 512.0)], "device string, gpu_memory_mb double")
    two = reports.scored(reports.add_device_memory(two, devices))
    made = reports.unified_comparison({"first": one, "second": two})
    assert made.columns == ["model", "hardware", "accuracy", "training_time_s", "gpu_memory_mb", "source"]
    assert sorted(rows_of(made)) == [("m", None, 0.5, None, None, "first"),
                                     ("n", "CUDA 1", 0.7, 3.0, 512.0, "second")]
    assert reports.scored(two, name_contains="z").count() == 0
