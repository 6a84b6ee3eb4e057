"""Tumbling windows counted from the start of each segment, and features per window.

The start of a segment is an aggregate of few rows, attached by broadcast when it is measured to
be small. Few columns are then shuffled once, as partial aggregates per window. With many columns those
would be far larger than the rows, so the rows are shuffled, before the columns derived from them are
computed. Hot segments and hot windows are combined on the map side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import micros, whole_micros, window_index
from windrow.operators.joins import attach, hot_keys, is_small, join_rows, key_hash, spread_join
from windrow.session import durable


COLUMNS_AT_ONCE = 12   # whose statistics one compiled aggregate still holds
STATISTICS = ("mean", "std", "min", "max")


@dataclass(frozen=True)
class WindowSpec:
    """Windows of ``seconds`` inside segments given by ``segment`` columns."""

    segment: tuple[str, ...]
    time: str
    seconds: float = 5.0
    window: str = "window_id"
    spread: tuple[str, ...] | None = field(default=None)

    @property
    def keys(self) -> list[str]:
        return [*self.segment, self.window]


def segment_origin(df: DataFrame, spec: WindowSpec, name: str = "origin_us") -> DataFrame:
    """First instant of each segment, in microseconds."""
    return df.groupBy(*spec.segment).agg(F.min(micros(df, spec.time)).alias(name))


def assign_windows(df: DataFrame, spec: WindowSpec) -> DataFrame:
    """Add the number of the window, counted from the first instant of the row's segment."""
    origins = durable(segment_origin(df, spec, "_origin"))
    placed = attach(df, origins, spec.segment, "inner", spread=spec.spread, nulls_match=True)
    length = whole_micros(spec.seconds)
    return placed.select(
        *df.columns, window_index(micros(df, spec.time), F.col("_origin"), length)
        .alias(spec.window))


def statistics(columns: Sequence[str]) -> list[Column]:
    """Mean, sample deviation, minimum and maximum of every column.

    The deviation is null for a window of one row and 0 for a constant one.
    """
    made = []
    for c in columns:
        made += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return made


def magnitude_areas(groups: Mapping[str, Sequence[str]]) -> list[Column]:
    """Mean of the summed absolute axes per group; a row lacking an axis is left out."""
    made = []
    for name, axes in groups.items():
        total = F.abs(F.col(axes[0]))
        for axis in axes[1:]:
            total = total + F.abs(F.col(axis))
        made.append(F.avg(total).alias(f"{name}_sma"))
    return made


def aggregate_windows(windowed: DataFrame, spec: WindowSpec, columns: Sequence[str],
                      groups: Mapping[str, Sequence[str]] | None = None,
                      count: str = "sample_count", derived: Mapping[str, Column] | None = None
                      ) -> DataFrame:
    """Count, statistics and magnitude areas per window.

    ``derived`` columns are computed from those of ``windowed`` and used like them. Many columns are
    aggregated in sets, joined by the window, which the sets are partitioned by already: an
    aggregate with hundreds of buffers is too large to be compiled, and slower than several scans
    of few columns each. Rows are brought to their window first, one shuffle for all sets that read
    the same columns; only windows that hold more than an even part of the rows are combined on
    the map side.
    """
    areas, made = dict(groups or {}), dict(derived or {})
    sets = max(1, math.ceil(len(columns) / COLUMNS_AT_ONCE))
    if sets == 1:
        return windowed.withColumns(made).groupBy(*spec.keys).agg(
            F.count(F.lit(1)).alias(count), *statistics(columns), *magnitude_areas(areas))
    # a struct of the keys joins like a key, and equals itself where one is null
    keyed = windowed.withColumn("_key", F.struct(*spec.keys))
    hot = list(hot_keys(windowed, spec.keys))
    is_hot = key_hash(windowed, spec.keys).isin(hot)
    rows = keyed.filter(~is_hot) if hot else keyed
    found = _in_sets(rows.repartition("_key").withColumns(made), columns, areas, count, sets)
    if hot:
        found = found.unionByName(
            _in_sets(keyed.filter(is_hot).withColumns(made), columns, areas, count, sets))
    order = [f"{c}_{kind}" for c in columns for kind in STATISTICS] + [f"{n}_sma" for n in areas]
    return found.select("_key.*", count, *order)


def _in_sets(keyed: DataFrame, columns: Sequence[str], areas: Mapping[str, Sequence[str]],
             count: str, sets: int) -> DataFrame:
    names, made = list(areas), None
    for i in range(sets):
        # neighbours, so that sets of columns derived in turn from few others read the same ones
        of, of_names = (part[i * len(part) // sets:(i + 1) * len(part) // sets]
                        for part in (columns, names))
        counted = [F.count(F.lit(1)).alias(count)] if i == 0 else []
        part = keyed.groupBy("_key").agg(
            *counted, *statistics(of), *magnitude_areas({n: areas[n] for n in of_names}))
        made = part if made is None else made.join(part, "_key")
    return made


def least_rows(seconds: float, rate: float, fill: float) -> int:
    """Rows a window needs: a share of those expected at the sampling rate."""
    return int(int(seconds * rate) * fill)


def gate(features: DataFrame, least: int, count: str = "sample_count") -> DataFrame:
    """Keep the windows with enough rows."""
    return features.filter(F.col(count) >= least)


def window_features(df: DataFrame, spec: WindowSpec, columns: Sequence[str],
                    groups: Mapping[str, Sequence[str]] | None = None, least: int = 1,
                    keep_helpers: bool = False, derived: Mapping[str, Column] | None = None
                    ) -> DataFrame:
    """One feature row per sufficiently filled window."""
    made = gate(aggregate_windows(assign_windows(df, spec), spec, columns, groups,
                                  derived=derived), least)
    return made if keep_helpers else made.drop(spec.window, "sample_count")


def window_population(windowed: DataFrame, spec: WindowSpec, by: Sequence[str]) -> DataFrame:
    """Rows, windows spanned and the highest window number per group."""
    return windowed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(spec.window).alias("max_window"))


def complete_windows(windowed: DataFrame, spec: WindowSpec, length: int) -> DataFrame:
    """Keys of the windows with exactly ``length`` rows."""
    return (windowed.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") == length).drop("_n"))


def keep_complete(windowed: DataFrame, spec: WindowSpec, length: int) -> DataFrame:
    """Rows of the complete windows.

    When the list of complete windows is too long to broadcast, rows and list are shuffled by
    window; a window that holds a large share of the rows is spread over pieces.
    """
    complete = durable(complete_windows(windowed, spec, length))
    if is_small(complete):
        return join_rows(windowed, F.broadcast(complete), spec.keys, "left_semi", nulls_match=True)
    return keep_complete_spread(windowed, spec, length, complete)


def keep_complete_spread(windowed: DataFrame, spec: WindowSpec, length: int,
                         complete: DataFrame | None = None) -> DataFrame:
    """The shuffle path of :func:`keep_complete`; a null is a key like any other."""
    if complete is None:
        complete = complete_windows(windowed, spec, length)
    return spread_join(windowed, complete, spec.keys, "left_semi", spec.spread, nulls_match=True)
