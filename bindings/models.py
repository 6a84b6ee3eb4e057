from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import query, table
from windrow.ml import importance, scaling, training
from windrow.operators import splits

DIMENSIONS = 64
WEAK_CORES = (1, 2, 4)          # fixed values: each with a quarter of the data per core


def vectors(spark, folder):
    """Embedding coordinates as feature columns, with the class to learn."""
    e = table(spark, folder, "embeddings")
    columns = [f"x{i:02d}" for i in range(DIMENSIONS)]
    return e.select("vec_id", "label", *[
        F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)]), columns


def _sides(spark, folder):
    df, columns = vectors(spark, folder)
    train, test = splits.split(df, ["vec_id"])
    return train, test, columns


def _ranked(spark, folder, specs):
    train, test, columns = _sides(spark, folder)
    made = training.run_suite(specs, train, test, columns, "label", ["vec_id"], parallelism=4)
    return made.leaderboard.select("model", F.round("accuracy", 4).alias("accuracy"),
                                   F.round("f1_weighted", 4).alias("f1_weighted"))


@query()
def model_suite(spark, folder):
    """Logistic regression, forest and perceptron, tuned by cross-validation and ranked."""
    return _ranked(spark, folder, training.standard_models()[:3])


@query()
def svm_suite(spark, folder):
    """The fourth standard model: ten classifiers per fit make it the longest of them."""
    return _ranked(spark, folder, training.standard_models()[3:])


@query()
def predict_lr(spark, folder):
    """Predictions with probabilities of a cross-validated logistic regression."""
    train, test, columns = _sides(spark, folder)
    classes = train.select("label").distinct().count()
    train = training.with_folds(train, ["vec_id"]).persist()
    model = training.cross_validator(training.logistic_regression(), columns, "label",
                                     classes, parallelism=4).fit(train)
    train.unpersist()
    made = training.prediction_table(model.transform(test), ["vec_id"])
    return training.trim_scores(made, classes).select(
        "vec_id", "label", "prediction", F.array_max("scores").alias("top_score"))


@query()
def topk_importance(spark, folder):
    df, columns = vectors(spark, folder)
    made = importance.forest_importances(df, columns, "label")
    return importance.top_features(made).select("feature", F.round("importance", 6).alias("importance"))


@query()
def scaling_run(spark, folder):
    """Cross-validated forest on growing shares of the data."""
    df, columns = vectors(spark, folder)
    return scaling.time_fractions(df, columns, "label", ["vec_id"]).drop("train_sec")


@query()
def weak_scaling_run(spark, folder):
    """One run on each share that keeps the rows per core constant, whatever cores this session has."""
    df, columns = vectors(spark, folder)
    runs = [scaling.time_weak(df, columns, "label", ["vec_id"], cores=cores).withColumn(
        "share_of_cores", F.lit(cores)) for cores in WEAK_CORES]
    return reduce(DataFrame.unionByName, runs).drop("train_sec")


@query()
def seed_stability(spark, folder):
    df, columns = vectors(spark, folder)
    return scaling.seed_stability(df, columns, "label", ["vec_id"],
                                  training.perceptron(iterations=(100,))).drop("train_sec")
