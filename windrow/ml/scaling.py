"""Training time as the data grows. Cores belong to the submit command, not to the code.

A strong-scaling table comes from running :func:`time_fractions` once per cluster size, a weak
one from growing the share of the data along with the cluster; the runs are joined afterwards by
``reports.scaling_table``.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame

from windrow.ml.training import (
    ModelSpec, cross_validator, evaluator_metrics, f1_evaluator, preparation, random_forest,
    with_folds,
)
from windrow.operators.splits import split, stable_sample

# The seeds of the stability report.
SEEDS = (42, 123, 256, 789, 1024)

RUN_SCHEMA = ("cores string, fraction double, rows bigint, train_rows bigint, train_sec double, "
              "accuracy double, f1_weighted double")
STABILITY_SCHEMA = ("run int, seed int, train_rows bigint, test_rows bigint, accuracy double, "
                    "f1_weighted double, precision_weighted double, recall_weighted double, "
                    "train_sec double")


def time_fractions(df: DataFrame, columns: Sequence[str], target: str, key: Sequence[str],
                   fractions: Sequence[float] = (0.25, 0.5, 0.75, 1.0),
                   spec: ModelSpec | None = None, folds: int = 3, seed: int = 42,
                   invalid: str = "skip") -> DataFrame:
    """Cross-validated fit per share of the data: one row per fraction."""
    spark = df.sparkSession
    spec = spec or random_forest(trees=(20,))
    rows = []
    for fraction in fractions:
        sampled = stable_sample(df, key, fraction, seed).persist()
        try:
            train, test = split(sampled, key, 0.8, seed + 1)
            train = with_folds(train, key, folds, seed)
            n, n_train = sampled.count(), train.count()
            classes = sampled.select(target).distinct().count()
            started = time.perf_counter()
            model = cross_validator(spec, columns, target, classes, folds, invalid=invalid).fit(train)
            seconds = time.perf_counter() - started
            predictions = model.transform(test)
            rows.append((spark.sparkContext.master, float(fraction), n, n_train, round(seconds, 1),
                         round(f1_evaluator("accuracy").evaluate(predictions), 4),
                         round(f1_evaluator("f1").evaluate(predictions), 4)))
        finally:
            sampled.unpersist()
    return spark.createDataFrame(rows, RUN_SCHEMA)


def time_weak(df: DataFrame, columns: Sequence[str], target: str, key: Sequence[str],
              share_per_core: float = 0.25, cores: int | None = None, **options) -> DataFrame:
    """One run on the share that keeps the rows per core constant for this session's cores."""
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    return time_fractions(df, columns, target, key,
                          fractions=[min(1.0, share_per_core * cores)], **options)


def seed_stability(df: DataFrame, columns: Sequence[str], target: str, key: Sequence[str],
                   spec: ModelSpec, seeds: Sequence[int] = SEEDS,
                   invalid: str = "keep") -> DataFrame:
    """The same model on several splits within one session: one row per seed.

    The grid of ``spec`` has one point; there is no cross-validation here.
    """
    spark = df.sparkSession
    df = df.persist()
    rows = []
    try:
        classes = df.select(target).distinct().count()
        settings = {name: values[0] for name, values in spec.grid.items()}
        for run, seed in enumerate(seeds, start=1):
            train, test = split(df, key, 0.8, seed)
            classifier = spec.build(len(columns), classes)
            owner = classifier.getClassifier() if spec.nested else classifier
            for name, value in settings.items():
                owner.set(owner.getParam(name), value)
            pipeline = Pipeline(stages=[*preparation(columns, target, invalid), classifier])
            started = time.perf_counter()
            model = pipeline.fit(train)
            seconds = time.perf_counter() - started
            scores = evaluator_metrics(model.transform(test))
            rows.append((run, int(seed), train.count(), test.count(), scores["accuracy"],
                         scores["f1"], scores["weightedPrecision"], scores["weightedRecall"],
                         round(seconds, 1)))
    finally:
        df.unpersist()
    return spark.createDataFrame(rows, STABILITY_SCHEMA)
