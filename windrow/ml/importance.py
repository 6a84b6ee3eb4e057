"""Feature importances of a surrogate forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame

from windrow.ml.training import FEATURES, LABEL, preparation
from windrow.operators.reports import top_rows


def forest_importances(df: DataFrame, columns: Sequence[str], target: str, trees: int = 50,
                       depth: int = 5, seed: int = 42, invalid: str = "keep") -> DataFrame:
    """(feature, importance) for every column, from Gini gains. Importances need no scaling."""
    forest = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, numTrees=trees,
                                    maxDepth=depth, seed=seed)
    stages = [*preparation(columns, target, invalid, scale=False), forest]
    model = Pipeline(stages=stages).fit(df).stages[-1]
    values = [float(v) for v in model.featureImportances.toArray()]
    return df.sparkSession.createDataFrame(list(zip(columns, values)),
                                           "feature string, importance double")


def top_features(importances: DataFrame, k: int = 20) -> DataFrame:
    return top_rows(importances, "importance", "feature", k)
