"""Window features as a pipeline stage that can be saved and loaded."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from windrow.operators.windows import WindowSpec, least_rows, window_features
from windrow.series import measure_columns


class WindowFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Samples in, one row of mean/std/min/max features per sufficiently filled window out."""

    windowSeconds = Param(Params._dummy(), "windowSeconds", "window length in seconds",
                          TypeConverters.toFloat)
    sampleRate = Param(Params._dummy(), "sampleRate", "expected rows per second",
                       TypeConverters.toFloat)
    timeCol = Param(Params._dummy(), "timeCol", "time column", TypeConverters.toString)
    segmentCols = Param(Params._dummy(), "segmentCols", "columns that delimit a segment",
                        TypeConverters.toListString)
    ignoreCols = Param(Params._dummy(), "ignoreCols", "double columns that are not measures",
                       TypeConverters.toListString)
    minFill = Param(Params._dummy(), "minFill", "share of the expected rows a window needs",
                    TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, windowSeconds: float = 5.0, sampleRate: float = 100.0,
                 timeCol: str = "timestamp", segmentCols: list[str] | None = None,
                 ignoreCols: list[str] | None = None, minFill: float = 0.5):
        super().__init__()
        self._setDefault(windowSeconds=5.0, sampleRate=100.0, timeCol="timestamp",
                         segmentCols=["subject_id", "activity_id"], ignoreCols=[], minFill=0.5)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        segment, time = get(self.segmentCols), get(self.timeCol)
        seconds = get(self.windowSeconds)
        spec = WindowSpec(tuple(segment), time, seconds)
        measures = measure_columns(dataset, [*segment, time, *get(self.ignoreCols)])
        least = least_rows(seconds, get(self.sampleRate), get(self.minFill))
        return window_features(dataset, spec, measures, least=least)
