"""All evaluation reports of one prediction table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from windrow.operators import evaluation, resampling, roc
from windrow.session import durable


def evaluate(predictions: DataFrame, replicates: int = 1000, label: str = "label",
             prediction: str = "prediction", scores: str | None = "scores"
             ) -> dict[str, DataFrame]:
    """Named report tables.

    The prediction table is reduced to cells once, for all reports but the curves.
    """
    cells = durable(evaluation.confusion_cells(predictions, label, prediction))
    reports = {
        "confusion_matrix": evaluation.confusion_matrix(cells),
        "per_class_metrics": evaluation.class_report(cells),
        "extended_metrics": evaluation.overall_metrics(cells),
        "bootstrap_ci": resampling.bootstrap_intervals(cells, replicates),
    }
    if scores is not None:
        long = roc.one_vs_rest(predictions, label, scores)
        reports["roc_curves"] = roc.roc_report(roc.cumulative_counts(long))
    return reports
