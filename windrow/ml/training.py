"""Model specifications and one routine that trains, scores and ranks them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions.hashing import hash_fraction
from windrow.ml.svm import SharedOneVsRest

LABEL, FEATURES, FOLD = "label_index", "feature_vector", "fold"


def preparation(columns: Sequence[str], target: str, invalid: str = "keep",
                scale: bool = True) -> list:
    """Label index, vector assembly and standardisation.

    The indexer keeps one extra index for labels it has not seen in training.
    """
    index = StringIndexer(inputCol=target, outputCol=LABEL, handleInvalid="keep",
                          stringOrderType="frequencyDesc")
    gather = VectorAssembler(inputCols=list(columns), handleInvalid=invalid,
                             outputCol="raw_vector" if scale else FEATURES)
    if not scale:
        return [index, gather]
    return [index, gather, StandardScaler(inputCol="raw_vector", outputCol=FEATURES,
                                          withMean=True, withStd=True)]


@dataclass(frozen=True)
class ModelSpec:
    """A name, a classifier for (features, classes), and the grid to search."""

    name: str
    build: Callable[[int, int], Estimator]
    grid: dict[str, Sequence] = field(default_factory=dict)
    nested: bool = False  # the grid belongs to the classifier inside a one-vs-rest reduction


def logistic_regression(grid: Sequence[float] = (0.01, 0.1), iterations: int = 100) -> ModelSpec:
    return ModelSpec("Logistic Regression", lambda n, k: LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=iterations, family="multinomial"),
        {"regParam": grid})


def random_forest(trees: Sequence[int] = (20, 50), depth: int = 5, seed: int = 42) -> ModelSpec:
    return ModelSpec("Random Forest", lambda n, k: RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, maxDepth=depth, seed=seed), {"numTrees": trees})


def perceptron(iterations: Sequence[int] = (50, 100), hidden: int = 64, block: int = 128,
               seed: int = 42) -> ModelSpec:
    return ModelSpec("Multilayer Perceptron", lambda n, k: MultilayerPerceptronClassifier(
        featuresCol=FEATURES, labelCol=LABEL, layers=[n, hidden, k], blockSize=block, seed=seed),
        {"maxIter": iterations})


def linear_svm(grid: Sequence[float] = (0.01, 0.1), iterations: int = 50, parallelism: int = 4
               ) -> ModelSpec:
    return ModelSpec("Linear SVM", lambda n, k: SharedOneVsRest(
        featuresCol=FEATURES, labelCol=LABEL, parallelism=parallelism,
        classifier=LinearSVC(featuresCol=FEATURES, labelCol=LABEL, maxIter=iterations)),
        {"regParam": grid}, nested=True)


def standard_models() -> list[ModelSpec]:
    return [logistic_regression(), random_forest(), perceptron(), linear_svm()]


def with_folds(df: DataFrame, key: Sequence[str], folds: int = 3, seed: int = 42) -> DataFrame:
    """Fold number from a hash of the key, the same on every cluster size."""
    fraction = hash_fraction(*key, F.lit("fold"), seed=seed)
    return df.withColumn(FOLD, F.least(F.floor(fraction * folds), F.lit(folds - 1)).cast("int"))


class FoldedCrossValidator(CrossValidator):
    """Cross-validation on the folds already marked in the data.

    MLlib checks a fold column with a Python function per row; here the folds are plain filters.
    Stages given by :meth:`prepared_by` are fitted once, on all rows, and what they make is kept as
    a narrow table of label, vector and fold while the folds are trained on it.
    """
    _before: tuple = ()

    def prepared_by(self, stages: Sequence) -> "FoldedCrossValidator":
        self._before = tuple(stages)
        return self

    def preparing(self, dataset: DataFrame) -> PipelineModel:
        return Pipeline(stages=list(self._before)).fit(dataset)

    def _fit(self, dataset: DataFrame):
        if not self._before:
            return super()._fit(dataset)
        before = self.preparing(dataset)
        narrow = before.transform(dataset).select(LABEL, self._before[-1].getOutputCol(), FOLD).persist()
        try:
            made = super()._fit(narrow)
        finally:
            narrow.unpersist()
        made.bestModel = PipelineModel(stages=[*before.stages, *made.bestModel.stages])
        return made

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        fold = F.col(FOLD)
        return [(dataset.filter(fold != i), dataset.filter(fold == i))
                for i in range(self.getNumFolds())]


def cross_validator(spec: ModelSpec, columns: Sequence[str], target: str, classes: int,
                    folds: int = 3, parallelism: int = 2, invalid: str = "keep", scale: bool = True) -> FoldedCrossValidator:
    """Grid search on weighted F1; the best model is a pipeline from the raw columns on.

    The data to fit carries the folds of :func:`with_folds`. Labels are indexed and vectors
    assembled once; what learns from the rows, the scaler included, is fitted on each fold.
    """
    classifier = spec.build(len(columns), classes)
    owner = classifier.getClassifier() if spec.nested else classifier
    grid = ParamGridBuilder()
    for name, values in spec.grid.items():
        grid.addGrid(owner.getParam(name), list(values))
    index, gather, *learned = preparation(columns, target, invalid, scale)
    return FoldedCrossValidator(
        estimator=Pipeline(stages=[*learned, classifier]), estimatorParamMaps=grid.build(),
        evaluator=f1_evaluator(), numFolds=folds, parallelism=parallelism).prepared_by([index, gather])


def f1_evaluator(metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction",
                                             metricName=metric)


def evaluator_metrics(predictions: DataFrame) -> dict[str, float]:
    """Accuracy, F1, weighted precision and recall from MLlib's evaluators."""
    return {m: f1_evaluator(m).evaluate(predictions)
            for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")}


@dataclass
class SuiteResult:
    leaderboard: DataFrame
    models: dict
    best: str

    def best_model(self):
        return self.models[self.best]


def run_suite(specs: Sequence[ModelSpec], train: DataFrame, test: DataFrame,
              columns: Sequence[str], target: str, key: Sequence[str], folds: int = 3,
              parallelism: int = 2, invalid: str = "keep") -> SuiteResult:
    """Tune every model on ``train``, score it on ``test`` and rank by weighted F1.

    Training passes over its input many times, so both sides are persisted while it runs.
    """
    spark = train.sparkSession
    train = with_folds(train, key, folds).persist()
    test = test.persist()
    try:
        classes = train.agg(F.count_distinct(target)).first()[0]
        rows, models = [], {}
        for spec in specs:
            spark.sparkContext.setJobDescription(f"train {spec.name}")
            started = time.perf_counter()
            fitted = cross_validator(spec, columns, target, classes, folds, parallelism,
                                     invalid=invalid).fit(train)
            trained = time.perf_counter()
            predictions = fitted.transform(test)
            accuracy = f1_evaluator("accuracy").evaluate(predictions)
            f1 = f1_evaluator("f1").evaluate(predictions)
            models[spec.name] = fitted.bestModel
            rows.append((spec.name, accuracy, f1, trained - started,
                         time.perf_counter() - trained))
        spark.sparkContext.setJobDescription(None)
    finally:
        train.unpersist()
        test.unpersist()
    board = spark.createDataFrame(rows, "model string, accuracy double, f1_weighted double, "
                                        "train_time_s double, eval_time_s double")
    best = min(rows, key=lambda r: (-r[2], r[0]))[0]
    return SuiteResult(board, models, best)


def prediction_table(predictions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Label, prediction and, where the model gives one, the probability array."""
    columns = [*keep, F.col(LABEL).cast("int").alias("label"),
               F.col("prediction").cast("int").alias("prediction")]
    if "probability" in predictions.columns:
        columns.append(vector_to_array("probability").alias("scores"))
    return predictions.select(*columns)


def trim_scores(table: DataFrame, classes: int, scores: str = "scores") -> DataFrame:
    """Drop the probability of the index kept for unseen labels."""
    return table.withColumn(scores, F.slice(scores, 1, classes))


def unseen_labels(table: DataFrame, classes: int) -> DataFrame:
    """Rows whose label was not in the training data, counted rather than scored."""
    return table.agg(F.count(F.when(F.col("label") >= classes, 1)).alias("n_unseen"))
