"""The batch job, layer by layer: raw samples, clean samples, filled and scaled samples, features.

Every function takes and returns DataFrames. Some start jobs that measure a table (slices, sizes of
lookups); only ``build`` writes: each layer, which also cuts the lineage between them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from windrow.functions.missing import nullify_nan
from windrow.operators import cleaning, quality, scaling
from windrow.operators.imputation import impute
from windrow.operators.ordering import ROWS_PER_SLICE
from windrow.operators.quality import Expectation
from windrow.operators.windows import WindowSpec, least_rows, window_features
from windrow.series import SeriesKey, measure_columns, triaxial_groups
from windrow.sources import readers, writers


@dataclass(frozen=True)
class Layout:
    """Column roles of a sample table."""

    subject: str = "subject_id"
    session: str = "session_type"
    label: str = "activity_id"
    label_name: str = "activity_name"
    time: str = "timestamp"
    tiebreak: str = "activity_id"
    sparse: tuple[str, ...] = ("heart_rate",)
    filler_label: int = 0
    dropped_family: str = "_orient_"
    places: tuple[str, ...] = readers.PLACES
    sensors: tuple[str, ...] = readers.TRIAXIAL_SENSORS
    fill_limit: int = 15
    window_seconds: float = 5.0
    rate: float = 100.0
    fill: float = 0.5
    rows_per_slice: int = field(default=ROWS_PER_SLICE)

    @property
    def metadata(self) -> list[str]:
        return [self.time, self.label, self.subject, self.session]

    @property
    def series(self) -> SeriesKey:
        return SeriesKey((self.subject, self.session), self.time, self.tiebreak)

    @property
    def windows(self) -> WindowSpec:
        return WindowSpec((self.subject, self.label), self.time, self.window_seconds)


def raw_layer(spark: SparkSession, folders: Mapping[str, str], layout: Layout = Layout(),
              **options) -> DataFrame:
    """All sessions, tagged with subject and session."""
    parts = {session: readers.read_samples(spark, folder, key=layout.subject, **options)
             for session, folder in folders.items()}
    return cleaning.union_sessions(parts, layout.session)


def raw_checks(raw: DataFrame, rows: tuple[int | None, int | None] = (1, None),
               subjects: int = 1, columns: int | None = None, layout: Layout = Layout()
               ) -> list[Expectation]:
    checks = [Expectation.row_count(*rows),
              Expectation.column_count(raw, columns or len(raw.columns)),
              Expectation.no_nulls(layout.time), Expectation.no_nulls(layout.label),
              Expectation.no_nulls(layout.subject),
              Expectation.distinct(layout.subject, subjects)]
    return checks + [Expectation.null_fraction(c, None, None) for c in layout.sparse]


def clean_layer(raw: DataFrame, names: DataFrame | None = None, layout: Layout = Layout()
                ) -> DataFrame:
    """No filler rows, no orientation columns, no rows without any reading, labels named."""
    kept = cleaning.drop_label(raw, layout.label, layout.filler_label)
    kept = cleaning.drop_family(kept, layout.dropped_family)
    sensors = [c for c in measure_columns(kept, layout.metadata) if c not in layout.sparse]
    kept = nullify_nan(cleaning.drop_all_missing(kept, sensors))
    if names is None:
        return kept
    return cleaning.lookup(kept, names.select(layout.label, layout.label_name), layout.label)


def filled_layer(clean: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Gaps of the sparse measures filled."""
    return impute(clean, layout.series, layout.sparse, layout.fill_limit, [layout.subject],
                  rows_per_slice=layout.rows_per_slice)


def scaled_layer(filled: DataFrame, fitted: DataFrame | None = None, layout: Layout = Layout()
                 ) -> DataFrame:
    """Every measure in [0, 1], by statistics of the table itself or those given."""
    measures = measure_columns(filled, layout.metadata)
    fitted = scaling.fit_minmax(filled, measures) if fitted is None else fitted
    return scaling.apply_minmax(filled, fitted, measures)


def feature_layer(scaled: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Window features with magnitude areas, of sufficiently filled windows."""
    measures = measure_columns(scaled, layout.metadata)
    groups = {name: axes for name, axes in triaxial_groups(layout.places, layout.sensors).items()
              if set(axes) <= set(measures)}
    least = least_rows(layout.window_seconds, layout.rate, layout.fill)
    return window_features(scaled, layout.windows, measures, groups, least)


def training_rows(features: DataFrame, layout: Layout = Layout()) -> tuple[DataFrame, list[str]]:
    """Feature rows ready for MLlib and their columns: NaN to zero, incomplete rows dropped."""
    columns = measure_columns(features, layout.metadata)
    return cleaning.drop_incomplete(cleaning.nan_to_zero(features, columns), columns), columns


def build(spark: SparkSession, folders: Mapping[str, str], target: str,
          names: DataFrame | None = None, layout: Layout = Layout(),
          checks: Sequence[Expectation] | None = None, **options) -> DataFrame:
    """Run the job: each layer is written below ``target`` and read back by the next.

    Every layer is counted while it is written and compared as read back: a difference stops the
    job. Returns the audit: (layer, fact, written, expected, passed).
    """
    audits: list[tuple] = []

    def store(df: DataFrame, layer: str) -> DataFrame:
        back, facts = writers.write_verified(
            df, f"{target.rstrip('/')}/{layer}",
            lambda rows, path: writers.write_partitioned(rows, path, [layout.subject]))
        audits.extend((layer, fact, *[None if v is None else Decimal(v) for v in values], passed)
                      for fact, *values, passed in facts)
        return back

    raw = raw_layer(spark, folders, layout, **options)
    quality.require(quality.expectations(raw, checks or raw_checks(raw, layout=layout)))
    raw = store(raw, "raw")
    clean = store(clean_layer(raw, names, layout), "clean")
    filled = store(filled_layer(clean, layout), "filled")
    scaled = store(scaled_layer(filled, layout=layout), "scaled")
    store(feature_layer(scaled, layout), "features")
    return spark.createDataFrame(audits, "layer string, fact string, written decimal(38,0), "
                                         "expected decimal(38,0), passed boolean")
