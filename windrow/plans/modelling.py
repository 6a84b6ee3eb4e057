"""From feature rows to a stored model and its twelve report tables, in one plan.

The reports are made with the model as read back from its folder, so they hold for what was stored.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.ml import importance, training
from windrow.ml.training import ModelSpec
from windrow.operators import quality, reports
from windrow.plans.evaluation import evaluate
from windrow.session import durable
from windrow.sources import writers

REPORTS = ("leaderboard", "best_model", "feature_importance", "class_histogram", "dataset_summary",
           "confusion_matrix", "per_class_metrics", "extended_metrics", "bootstrap_ci", "roc_curves",
           "predictions_per_class", "training_run")


@dataclass(frozen=True)
class Manifest:
    """What a stored model needs to be used: its columns in order, and the labels by index."""

    model: str
    columns: list[str]
    target: str
    labels: list[str]
    spark: str
    f1_weighted: float


def save_model(model: PipelineModel, manifest: Manifest, folder: str) -> None:
    """The model below ``folder/model`` and its manifest, last, below ``folder/manifest``."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{folder}/model")
    line = json.dumps(manifest.__dict__, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{folder}/manifest")


def load_model(folder: str) -> tuple[PipelineModel, Manifest]:
    """The model and manifest of :func:`save_model`; an error where the two do not belong together."""
    spark = SparkSession.active()
    manifest = Manifest(**json.loads(spark.read.text(f"{folder}/manifest").first()[0]))
    model = PipelineModel.load(f"{folder}/model")
    if list(model.stages[0].labels) != manifest.labels:
        raise ValueError(f"{folder}: the manifest is of another model")
    return model, manifest


def score(df: DataFrame, folder: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, label, prediction, scores) of the stored model, in place of any model in memory."""
    model, manifest = load_model(folder)
    missing = sorted(set(manifest.columns) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    made = training.prediction_table(model.transform(df), keep)
    return training.trim_scores(made, len(manifest.labels)) if "scores" in made.columns else made


def train_and_report(train: DataFrame, test: DataFrame, columns: Sequence[str], target: str,
                     key: Sequence[str], folder: str, specs: Sequence[ModelSpec],
                     folds: int = 3, replicates: int = 1000) -> Mapping[str, str]:
    """Train all, store the best with its manifest, score by what was stored, export the reports.

    Below ``folder`` lie ``model``, ``manifest``, ``predictions`` (Parquet), and ``reports/<name>``
    (CSV) for each of ``REPORTS``. Returns the report paths by name.
    """
    suite = training.run_suite(specs, train, test, columns, target, key, folds)
    best = reports.best_row(suite.leaderboard, "f1_weighted", "model")
    f1 = best.select("f1_weighted").first()[0]
    model = suite.best_model()
    save_model(model, Manifest(suite.best, list(columns), target, list(model.stages[0].labels),
                               pyspark.__version__, f1), folder)
    _, manifest = load_model(folder)
    predictions, _ = writers.write_verified(score(test, folder, key), f"{folder}/predictions",
                                            writers.write_table)
    seen = predictions.filter(F.col("label") < len(manifest.labels))
    with_scores = "scores" in predictions.columns
    made = evaluate(seen, replicates, scores="scores" if with_scores else None)
    if not with_scores:   # a model without probabilities has no curve
        made["roc_curves"] = predictions.sparkSession.createDataFrame(
            [], "class string, fpr double, tpr double, threshold double, auc double")
    made["leaderboard"], made["best_model"] = suite.leaderboard, best
    made["feature_importance"] = reports.top_rows(
        importance.forest_importances(train, columns, target), "importance", "feature", len(columns))
    both = train.select(target, *columns).withColumn("part", F.lit("train")).unionByName(
        test.select(target, *columns).withColumn("part", F.lit("test")))
    made["class_histogram"] = quality.group_counts(both, ["part", target])
    made["dataset_summary"] = quality.series_summary(both, [target], columns)
    made["predictions_per_class"] = durable(quality.group_counts(predictions, ["prediction"]))
    made["training_run"] = predictions.sparkSession.createDataFrame(
        [(manifest.model, manifest.spark, len(manifest.columns), len(manifest.labels), manifest.f1_weighted,
          predictions.count(), training.unseen_labels(predictions, len(manifest.labels)).first()[0])],
        "model string, spark string, n_columns int, n_labels int, f1_weighted double, "
        "n_scored bigint, n_unseen bigint")
    large = {"roc_curves": made.pop("roc_curves")}      # one row per distinct score
    paths = writers.export_reports(made, f"{folder}/reports")
    writers.write_csv(large["roc_curves"], f"{folder}/reports/roc_curves")
    return dict(zip(made, paths)) | {"roc_curves": f"{folder}/reports/roc_curves"}
