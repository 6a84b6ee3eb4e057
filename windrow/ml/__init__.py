"""MLlib: a pipeline stage, model specifications, training, importances, scaling runs."""

from windrow.ml.stage import WindowFeatures

__all__ = ["WindowFeatures"]
