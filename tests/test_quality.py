import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators import quality
from windrow.operators.quality import Expectation, ExpectationError


def test_audit_counts_null_and_nan_apart(samples):
    got = {r.column_name: (r.n_rows, r.n_null, r.n_nan) for r in quality.missing_audit(samples).collect()}
    assert got["m1"] == (10, 1, 1) and got["m3"] == (10, 3, 0) and got["session"] == (10, 0, 0)


def test_expectations_pass_and_fail(samples):
    report = quality.expectations(samples, [
        Expectation.row_count(1, 10), Expectation.no_nulls("subject"),
        Expectation.null_fraction("m3", 0.3, 0.3), Expectation.distinct("subject", 3),
        Expectation.column_count(samples, 7)])
    assert [r.passed for r in report.collect()] == [True, True, True, False, True]
    with pytest.raises(ExpectationError, match="distinct_subject"):
        quality.require(report)
    quality.require(report.filter("passed"))


def test_expectations_on_an_empty_table(samples):
    report = quality.expectations(samples.limit(0), [
        Expectation.row_count(1), Expectation.null_fraction("m3", None, 0.5)])
    assert [r.passed for r in report.collect()] == [False, False]


def test_distinct_count_counts_combinations(samples):
    assert quality.distinct_count(samples, ["subject", "session"]).first()[0] == 3
    assert quality.distinct_count(samples, ["subject"], approximate=True).first()[0] == 2


@pytest.mark.parametrize("rows_per_slice", [None, 40])
def test_exact_percentiles(spark, rows_per_slice):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=300), np.zeros(200)]).round(3)
    frame = [(float(v), None if i % 7 == 0 else float(i)) for i, v in enumerate(values)]
    df = spark.createDataFrame(frame, "a double, b double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.measure, r.share): r.value
           for r in quality.exact_percentiles(df, ["a", "b"], shares, rows_per_slice).collect()}
    others = np.array([b for _, b in frame if b is not None])
    for s in shares:
        assert got["a", s] == pytest.approx(np.quantile(values, s), abs=1e-9)
        assert got["b", s] == pytest.approx(np.quantile(others, s), abs=1e-9)


def test_summary_and_facts(samples):
    facts = dict(rows_of(quality.series_summary(samples, ["subject"], ["t"])))
    assert facts == {"rows": 10, "columns": 7, "distinct_subject": 2, "min_t": 0.0, "max_t": 100.0}
    assert quality.summary(samples, ["t"]).count() == 5


def test_group_counts(samples):
    got = rows_of(quality.group_counts(samples, ["label"]).orderBy(F.col("label")))
    assert got == [(0, 2), (1, 7), (2, 1)]
