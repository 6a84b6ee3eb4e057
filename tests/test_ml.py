import inspect

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.ml import WindowFeatures, importance, scaling, training
from windrow.operators import splits, windows
from windrow.operators.windows import WindowSpec


@pytest.fixture(scope="module")
def separable(spark):
    """Three classes; only the first two of four columns tell them apart."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, f"class{c}", float(c + rng.normal(0, .2)), float(-c + rng.normal(0, .3)),
                     float(rng.normal()), float(rng.normal())))
    return spark.createDataFrame(rows, "id int, kind string, a double, b double, c double, d double")


COLUMNS = ["a", "b", "c", "d"]


def test_stage_equals_the_operator_and_survives_saving(spark, tiny, tmp_path):
    df = spark.read.parquet(f"{tiny}/events.parquet").select("ts", "user_id", "event_type", "value")
    stage = WindowFeatures(windowSeconds=864_000.0, sampleRate=1e-5, timeCol="ts",
                           segmentCols=["user_id", "event_type"], minFill=0.25)
    stage.write().overwrite().save(f"{tmp_path}/stage")
    loaded = WindowFeatures.load(f"{tmp_path}/stage")
    spec = WindowSpec(("user_id", "event_type"), "ts", 864_000.0)
    want = sorted(rows_of(windows.window_features(df, spec, ["value"], least=2)), key=str)
    assert sorted(rows_of(loaded.transform(df)), key=str) == want
    assert loaded.getOrDefault(loaded.minFill) == 0.25
    defaults = WindowFeatures()
    assert defaults.getOrDefault(defaults.segmentCols) == ["subject_id", "activity_id"]


def test_suite_ranks_models_and_keeps_the_best(spark, separable, tmp_path):
    train, test = splits.split(separable, ["id"])
    specs = [training.logistic_regression(grid=(0.01,), iterations=20),
             training.random_forest(trees=(5,)), training.perceptron(iterations=(20,), hidden=8),
             training.linear_svm(grid=(0.01,), iterations=10)]
    made = training.run_suite(specs, train, test, COLUMNS, "kind", ["id"], folds=2)
    board = {r.model: r for r in made.leaderboard.collect()}
    assert set(board) == {s.name for s in specs}
    assert all(board[n].accuracy > 0.85 for n in ("Logistic Regression", "Random Forest"))
    assert board[made.best].f1_weighted == max(r.f1_weighted for r in board.values())
    from pyspark.ml import PipelineModel
    made.best_model().write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model").transform(test)
    assert training.f1_evaluator().evaluate(again) == pytest.approx(board[made.best].f1_weighted)


def test_the_grid_reaches_the_classifier_inside_one_vs_rest(separable):
    cv = training.cross_validator(training.linear_svm(grid=(0.0, 50.0), iterations=5), COLUMNS, "kind",
                                  3, folds=2)
    fitted = cv.getEstimator().fit(cv.preparing(separable).transform(separable),
                                   cv.getEstimatorParamMaps())
    norms = [m.stages[-1].models[0].coefficients.norm(2) for m in fitted]
    assert norms[0] > 2 * norms[1]


def test_kept_index_is_trimmed_from_the_scores(separable):
    train, test = splits.split(separable, ["id"])
    classifier = training.logistic_regression(iterations=5).build(4, 3)
    from pyspark.ml import Pipeline
    model = Pipeline(stages=[*training.preparation(COLUMNS, "kind"), classifier]).fit(
        train.filter("kind <> 'class2'"))
    made = training.prediction_table(model.transform(test), ["id"])
    assert made.select(F.size("scores")).first()[0] == 3
    assert training.trim_scores(made, 2).select(F.size("scores")).first()[0] == 2
    assert training.unseen_labels(made, 2).first()[0] == test.filter("kind = 'class2'").count()


def test_folds_do_not_depend_on_the_layout(separable):
    a = dict(rows_of(training.with_folds(separable.repartition(5), ["id"]).select("id", "fold")))
    b = dict(rows_of(training.with_folds(separable, ["id"]).select("id", "fold")))
    assert a == b and set(a.values()) == {0, 1, 2}


def test_importances_find_the_telling_columns(separable):
    made = importance.forest_importances(separable, COLUMNS, "kind", trees=10)
    assert made.count() == 4 and made.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert {r.feature for r in importance.top_features(made, 2).collect()} == {"a", "b"}


def test_scaling_and_stability_runs(separable):
    spec = training.random_forest(trees=(3,), depth=2)
    runs = scaling.time_fractions(separable, COLUMNS, "kind", ["id"], (0.5, 1.0), spec, folds=2).collect()
    assert [r.fraction for r in runs] == [0.5, 1.0] and runs[1].rows == 240
    assert runs[0].rows < runs[1].rows and all(r.train_rows < r.rows for r in runs)
    weak = scaling.time_weak(separable, COLUMNS, "kind", ["id"], 0.25, cores=2, spec=spec, folds=2)
    assert weak.first().fraction == 0.5
    stable = scaling.seed_stability(separable, COLUMNS, "kind", ["id"], spec, seeds=(1, 2)).collect()
    assert [r.seed for r in stable] == [1, 2] and all(r.train_rows + r.test_rows == 240 for r in stable)


def test_registered_runs_use_full_settings(monkeypatch):
    """The registered queries hand the operators' own fractions, seeds and grid to them."""
    from bindings import metrics, models
    from windrow.ml import scaling

    seen = {}
    monkeypatch.setattr(models, "vectors", lambda spark, folder: (None, ["x"]))

    class Made:
        def drop(self, *_): return self
        def withColumn(self, *_): return self
        def unionByName(self, _): return self

    def note(name, function):
        def called(*args, **given):
            bound = inspect.signature(function).bind(*args, **given)
            bound.apply_defaults()
            seen.setdefault(name, []).append(bound.arguments)
            return Made()
        return called
    for name in ("time_fractions", "time_weak", "seed_stability"):
        monkeypatch.setattr(scaling, name, note(name, getattr(scaling, name)))
    monkeypatch.setattr(models, "DataFrame", Made)
    monkeypatch.setattr(models.F, "lit", lambda x: x)
    models.scaling_run(None, "")
    models.seed_stability(None, "")
    models.weak_scaling_run(None, "")
    assert seen["time_fractions"][0]["fractions"] == (0.25, 0.5, 0.75, 1.0)
    assert seen["seed_stability"][0]["seeds"] == scaling.SEEDS
    assert [(r["cores"], r["share_per_core"]) for r in seen["time_weak"]] == [
        (1, 0.25), (2, 0.25), (4, 0.25)]
    assert metrics.REPLICATES == 1000


def test_a_stored_model_and_its_reports(spark, separable, tmp_path):
    """Train, store, load, score by what was loaded, and read all twelve reports back."""
    from windrow.plans import modelling
    columns, target, key = COLUMNS, "kind", ["id"]
    train, test = splits.split(separable, key)
    folder = str(tmp_path / "run")
    paths = modelling.train_and_report(train, test, columns, target, key, folder, [
        training.logistic_regression((0.01,), 10), training.random_forest((3,), 3)], replicates=20)
    assert set(paths) == set(modelling.REPORTS) and len(paths) == 12
    back = {n: spark.read.option("header", True).csv(p) for n, p in paths.items()}
    assert all(df.count() > 0 for df in back.values())
    model, manifest = modelling.load_model(folder)
    assert manifest.columns == list(columns) and manifest.model in ("Logistic Regression", "Random Forest")
    stored = spark.read.parquet(f"{folder}/predictions")
    again = modelling.score(test, folder, key)
    assert stored.count() == test.count() and stored.exceptAll(again.select(stored.columns)).count() == 0
    run = back["training_run"].first()
    assert int(run.n_scored) == test.count() and float(run.f1_weighted) > 0.8
    with pytest.raises(ValueError, match="missing"):
        modelling.score(test.drop(columns[0]), folder)


def test_svm_classes_share_passes(spark):
    """All classes in common jobs, to the coefficients of MLlib's one against the rest."""
    import numpy as np
    from pyspark.ml.classification import OneVsRest
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from windrow.ml import training
    noise = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 - 0.5) for i in range(4)]
    df = spark.range(300).select(
        (F.col("id") % 3).cast("double").alias(training.LABEL), array_to_vector(F.array(
            *[n * 3 + F.when(F.col("id") % 6 == i, 2.0).otherwise(F.col("id") % 6 / 9.0)
              for i, n in enumerate(noise)], F.lit(7.0))).alias(training.FEATURES)).coalesce(1).persist()
    shared = training.linear_svm(iterations=8).build(5, 3)
    shared.getClassifier().setRegParam(0.1)
    plain = OneVsRest(classifier=shared.getClassifier(), featuresCol=training.FEATURES,
                      labelCol=training.LABEL)

    def fitted(estimator, group):
        spark.sparkContext.setJobGroup(group, "svm")
        try:
            return estimator.fit(df), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    (made, jobs), (other, jobs_before) = fitted(shared, "svm-shared"), fitted(plain, "svm-plain")
    assert 0 < 2 * jobs < jobs_before
    for ours, theirs in zip(made.models, other.models):
        assert np.allclose(ours.coefficients.toArray(), theirs.coefficients.toArray(), rtol=0, atol=1e-6)
        assert abs(ours.intercept - theirs.intercept) < 1e-6
    assert made.models[0].coefficients[4] == 0
    ours, theirs = (m.transform(df).select("prediction").collect() for m in (made, other))
    df.unpersist()
    assert ours == theirs
