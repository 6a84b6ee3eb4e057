import math

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.ml import training
from windrow.operators import evaluation, resampling, roc
from windrow.plans.evaluation import evaluate

RNG = np.random.default_rng(11)
N = 600
TRUTH = RNG.integers(0, 4, N)                      # class 4 is never true
GUESS = np.where(RNG.random(N) < 0.6, TRUTH, RNG.choice([0, 1, 4], N))  # 3 only when right
GUESS[GUESS == 2] = 0                              # class 2 is never predicted
SCORES = (RNG.random((N, 4)).round(2) * 0.5 + 0.5 * np.eye(4)[TRUTH] * RNG.random((N, 1))).round(2)


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [(i, int(t), int(g), [float(x) for x in s])
            for i, (t, g, s) in enumerate(zip(TRUTH, GUESS, SCORES))]
    return spark.createDataFrame(rows, "id int, label int, prediction int, scores array<double>")


@pytest.fixture(scope="module")
def cells(predictions):
    return evaluation.confusion_cells(predictions)


def reference_scores():
    out = {}
    for c in range(5):
        tp = np.sum((TRUTH == c) & (GUESS == c))
        p, s = np.sum(GUESS == c), np.sum(TRUTH == c)
        prec, rec = (tp / p if p else 0.0), (tp / s if s else 0.0)
        out[c] = (prec, rec, 2 * prec * rec / (prec + rec) if prec + rec else 0.0, int(s))
    return out


def test_matrix_is_dense_and_normalised(cells):
    got = {(r.label, r.prediction): (r.n, r.normalised) for r in evaluation.confusion_matrix(cells).collect()}
    assert len(got) == 25 and sum(n for n, _ in got.values()) == N
    for (t, p), (n, share) in got.items():
        row = np.sum(TRUTH == t)
        assert n == np.sum((TRUTH == t) & (GUESS == p))
        assert share == pytest.approx(n / row if row else 0.0)


def test_class_report(cells):
    report = evaluation.class_report(cells).collect()
    want = reference_scores()
    for r in report:
        assert (r.precision, r.recall, r.f1_score, r.support) == pytest.approx(want[r["class"]])
    assert [r.f1_score for r in report] == sorted(r.f1_score for r in report)


def test_overall(cells):
    got = evaluation.overall_metrics(cells).first()
    want = reference_scores()
    weight = {c: w[3] / N for c, w in want.items()}
    assert got.accuracy == pytest.approx(np.mean(TRUTH == GUESS)) == got.recall_weighted
    assert got.precision_weighted == pytest.approx(sum(want[c][0] * weight[c] for c in want))
    assert got.f1_weighted == pytest.approx(sum(want[c][2] * weight[c] for c in want))
    assert got.f1_macro == pytest.approx(np.mean([w[2] for w in want.values()]))
    t, p = np.eye(5)[TRUTH].sum(0), np.eye(5)[GUESS].sum(0)
    po, pe = np.mean(TRUTH == GUESS), float(t @ p) / N**2
    assert got.cohen_kappa == pytest.approx((po - pe) / (1 - pe))
    mcc = (po * N * N - t @ p) / math.sqrt((N**2 - p @ p) * (N**2 - t @ t))
    assert got.mcc == pytest.approx(mcc)


def test_degenerate_overall(spark):
    one = spark.createDataFrame([(1, 1)] * 3, "label int, prediction int")
    got = evaluation.overall_metrics(evaluation.confusion_cells(one)).first()
    assert got.mcc == 0.0 and got.cohen_kappa is None and got.accuracy == 1.0


def test_mllib_evaluators_agree(predictions, cells):
    frame = predictions.select(F.col("label").cast("double").alias(training.LABEL),
                               F.col("prediction").cast("double").alias("prediction"))
    theirs, ours = training.evaluator_metrics(frame), evaluation.overall_metrics(cells).first()
    assert theirs["accuracy"] == pytest.approx(ours.accuracy)
    assert theirs["f1"] == pytest.approx(ours.f1_weighted)
    assert theirs["weightedPrecision"] == pytest.approx(ours.precision_weighted)
    assert theirs["weightedRecall"] == pytest.approx(ours.recall_weighted)


@pytest.mark.parametrize("rows_per_slice", [10**6, 100])
def test_roc_points_and_area(predictions, rows_per_slice):
    cumulative = roc.cumulative_counts(roc.one_vs_rest(predictions, "label", "scores"), rows_per_slice)
    points = roc.roc_points(cumulative).collect()
    areas = {r["class"]: r.auc for r in roc.auc(cumulative).collect()}
    for c in range(4):
        hit, score = TRUTH == c, SCORES[:, c]
        got = sorted((-math.inf if p.threshold is None else -p.threshold, p.fpr, p.tpr)
                     for p in points if p["class"] == c)
        want = [(-math.inf, 0.0, 0.0)] + [
            (-s, np.mean(score[~hit] >= s), np.mean(score[hit] >= s)) for s in np.unique(score)[::-1]]
        np.testing.assert_allclose(got, want)
        above = np.mean((score[hit][:, None] > score[~hit]) + 0.5 * (score[hit][:, None] == score[~hit]))
        assert areas[c] == pytest.approx(above)  # rank form of the area


def test_macro_curve_is_interpolated_like_numpy(predictions):
    cumulative = roc.cumulative_counts(roc.one_vs_rest(predictions, "label", "scores"), 100)
    grid, total = np.linspace(0, 1, 200), np.zeros(200)
    for c in range(4):
        hit, score = TRUTH == c, SCORES[:, c]
        levels = np.unique(score)[::-1]
        fpr = [0.0] + [np.mean(score[~hit] >= s) for s in levels]
        tpr = [0.0] + [np.mean(score[hit] >= s) for s in levels]
        total += np.interp(grid, fpr, tpr)
    got = roc.macro_roc(cumulative).orderBy("step").collect()
    np.testing.assert_allclose([r.tpr for r in got], total / 4, atol=1e-9)
    area = roc.curve_area(roc.macro_roc(cumulative)).first()[0]
    assert area == pytest.approx(np.trapezoid(total / 4, grid))


def test_class_without_positives_has_no_area(spark):
    df = spark.createDataFrame([(0, [0.2, 0.8]), (0, [0.4, 0.6])], "label int, scores array<double>")
    cumulative = roc.cumulative_counts(roc.one_vs_rest(df, "label", "scores"))
    assert {r.auc for r in roc.auc(cumulative).collect()} == {None}
    assert roc.macro_roc(cumulative).count() == 0


def test_bootstrap_is_near_a_resampling_of_the_rows(cells):
    got = {r.metric: r for r in resampling.bootstrap_intervals(cells, 2000, seed=1).collect()}
    rng = np.random.default_rng(0)
    acc = [np.mean((TRUTH == GUESS)[rng.integers(0, N, N)]) for _ in range(2000)]
    lo, hi = np.quantile(acc, [0.025, 0.975])
    r = got["accuracy"]
    assert r.ci_lower == pytest.approx(lo, abs=0.006) and r.ci_upper == pytest.approx(hi, abs=0.006)
    assert r.observed == pytest.approx(np.mean(TRUTH == GUESS)) and r.n_boot == 2000
    f1 = got["f1_weighted"]
    assert f1.ci_lower < f1.observed < f1.ci_upper


def exact_poisson(mean, us):
    """Quantiles from the ratios of neighbouring chances, scaled to add up to 1."""
    reach = int(12 * math.sqrt(mean)) + 80
    low, high = max(0, int(mean) - reach), int(mean) + reach
    k = np.arange(low, high + 1, dtype=float)
    logs = np.concatenate([[0.0], np.cumsum(np.log(mean) - np.log(k[1:]))])
    chance = np.exp(logs - logs.max())
    upto = np.cumsum(chance / math.fsum(chance))
    return [low + int(np.searchsorted(upto, u)) for u in us], upto


@pytest.mark.parametrize("mean", [0.5, 7.0, 30.0, 31.0, 400.0, 1e4, 1e6])
def test_poisson_quantiles_are_exact_at_every_mean(spark, mean):
    us = [1e-10, 1e-6, 0.025, 0.5, 0.975, 1 - 1e-10, *np.random.default_rng(3).random(300)]
    draws = spark.createDataFrame([(1, i, float(u)) for i, u in enumerate(us)] + [(2, 0, 0.4)],
                                  "cell int, i int, u double")
    means = spark.createDataFrame([(1, mean), (2, 0.0)], "cell int, mean double")
    rows = resampling.poisson_quantiles(means, draws, ["cell"], "mean", "u", "k").collect()
    got = {(r.cell, r.i): r.k for r in rows}
    want, upto = exact_poisson(mean, us)
    assert got[2, 0] == 0 and len(got) == len(us) + 1
    for i, (u, k) in enumerate(zip(us, want)):
        if np.abs(upto - u).min() > 1e-9:       # a draw on a step is told by the last digits only
            assert got[1, i] == k, (mean, u)


def test_bootstrap_repeats_and_counts_replicates(cells):
    drawn = resampling.replicate_cells(cells, 37)
    assert drawn.select("replicate").distinct().count() == 37
    again = resampling.replicate_cells(cells.repartition(3), 37)
    assert sorted(rows_of(drawn)) == sorted(rows_of(again))


def test_mcnemar(spark):
    first = spark.createDataFrame([(i, 1, 1 if i < 20 else 0) for i in range(30)], "id int, label int, prediction int")
    second = spark.createDataFrame([(i, 1, 1 if i >= 15 else 0) for i in reversed(range(30))],
                                   "id int, label int, prediction int")
    r = evaluation.mcnemar(first, second, "id").first()
    assert (r.b00, r.b01, r.b10, r.b11) == (5, 15, 10, 0)
    assert r.statistic == pytest.approx(16 / 25)
    assert r.p_value == pytest.approx(math.erfc(math.sqrt(0.32)), abs=1e-6)
    assert r.decision == "not significant"
    plain = evaluation.mcnemar(first, second, "id", correction=False).first()
    assert plain.statistic == pytest.approx(1.0)
    same = evaluation.mcnemar(first, first, "id").first()
    assert (same.statistic, same.p_value, same.decision) == (0.0, 1.0, "not significant")


def test_all_reports(predictions):
    reports = evaluate(predictions, replicates=50)
    assert set(reports) == {"confusion_matrix", "per_class_metrics", "extended_metrics",
                            "bootstrap_ci", "roc_curves"}
    curves = reports["roc_curves"]
    assert curves.filter("class = 'MACRO_AVG'").count() == 200
    assert curves.columns == ["class", "fpr", "tpr", "threshold", "auc"]


def test_mcnemar_counts_what_has_no_partner(spark):
    first = spark.createDataFrame(
        [(1, 0, 0), (2, 0, 1), (3, 1, None), (4, 1, 1), (None, 1, 1)], "i int, label int, prediction int")
    second = spark.createDataFrame([(1, 0, 1), (3, 1, 1), (9, 0, 0)], "i int, label int, prediction int")
    r = evaluation.mcnemar(first, second, "i").first()
    assert (r.b00, r.b01, r.b10, r.b11) == (0, 1, 0, 0)
    assert (r.n_only_a, r.n_only_b, r.n_null) == (2, 1, 2)
    with pytest.raises(Exception, match="not unique"):
        evaluation.mcnemar(first.unionByName(first), second, "i").collect()
    none = evaluation.mcnemar(first.limit(0), second.limit(0), "i").first()
    assert (none.b00, none.n_null, none.decision) == (0, 0, "not significant")
