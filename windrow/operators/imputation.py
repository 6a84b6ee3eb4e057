"""Bounded gap filling in time order, with a group mean for what remains.

A fill looks at most ``limit`` rows back or ahead. Filling forward first and then filling the
rest backward gives the same as taking the last raw reading within ``limit`` rows before, or
else the first one within ``limit`` rows after: where the forward fill finds nothing, the nearest
filled value ahead is itself a raw reading. So one ordered window serves both directions.

A series that is longer than a slice is cut in the global order by time and tiebreak, so rows of one
instant are cut like any others. Each piece is filled on its own, and one record per
piece (its length, its first and last reading) tells the next and the previous pieces what lies
just beyond their edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.clock import micros
from windrow.functions.missing import nullify_nan
from windrow.operators.joins import attach
from windrow.operators.ordering import ROWS_PER_SLICE, in_slices
from windrow.series import SeriesKey
from windrow.session import durable

FORWARD, BACKWARD = "forward", "backward"


def bounded_fill(df: DataFrame, series: SeriesKey, columns: Sequence[str], limit: int = 15,
                 directions: Sequence[str] = (FORWARD, BACKWARD),
                 rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Fill nulls of ``columns`` from at most ``limit`` rows away, in the order of directions."""
    timed = with_position(df, series)
    sliced = in_slices(timed, "_us", [series.time, series.tiebreak], rows_per_slice, "_slice")
    if sliced is None:
        before, after = _near(series.keys, series, columns, limit)
        return df.select(*_filled(df.columns, columns, directions, before, after))
    return _fill_in_pieces(sliced, series, columns, limit, directions, rows_per_slice).select(*df.columns)


def with_position(df: DataFrame, series: SeriesKey) -> DataFrame:
    """Add ``_us``, which never falls along the order of the series: no time first, NaN last."""
    us = F.coalesce(micros(df, series.time).cast("double"), F.lit(-1e300))
    if isinstance(df.schema[series.time].dataType, (T.DoubleType, T.FloatType)):
        us = F.when(F.isnan(series.time), F.lit(1e300)).otherwise(us)
    return df.withColumn("_us", us)


def _near(parts: Sequence[str], series: SeriesKey, columns: Sequence[str], limit: int
          ) -> tuple[dict[str, Column], dict[str, Column]]:
    ordered = Window.partitionBy(*parts).orderBy(*series.order())
    back, ahead = ordered.rowsBetween(-limit, 0), ordered.rowsBetween(0, limit)
    return ({c: F.last(c, ignorenulls=True).over(back) for c in columns},
            {c: F.first(c, ignorenulls=True).over(ahead) for c in columns})


def _filled(names: Sequence[str], columns: Sequence[str], directions: Sequence[str],
            before: dict[str, Column], after: dict[str, Column]) -> list[Column]:
    source = {FORWARD: before, BACKWARD: after}
    return [F.coalesce(F.col(c), *[source[d][c] for d in directions]).alias(c)
            if c in columns else F.col(c) for c in names]


def _fill_in_pieces(sliced: DataFrame, series: SeriesKey, columns: Sequence[str], limit: int,
                    directions: Sequence[str], slice_rows: int) -> DataFrame:
    # a struct of the keys joins and partitions like a key, and equals itself where one is null
    sliced = sliced.withColumn("_series", F.struct(*series.keys))
    piece = ["_series", "_piece"]
    # fewer series than there are slices can be longer than a slice
    long_series = (sliced.groupBy("_series").agg(F.count(F.lit(1)).alias("_n"))
                   .filter(F.col("_n") > slice_rows).select("_series", F.lit(True).alias("_long")))
    pieces = sliced.join(F.broadcast(long_series), "_series", "left").withColumn(
        "_piece", F.when(F.col("_long"), F.col("_slice")).otherwise(F.lit(0)))

    in_piece = Window.partitionBy(*piece).orderBy(*series.order())
    before, after = _near(piece, series, columns, limit)
    local = pieces.select(
        *sliced.columns, "_piece", F.row_number().over(in_piece).alias("_row"),
        *[before[c].alias(f"_before_{c}") for c in columns],
        *[after[c].alias(f"_after_{c}") for c in columns])

    edges = _edges(pieces.filter(F.col("_long")), columns, in_piece)
    joined = local.join(edges, piece, "left")
    position = F.col("_start") + F.col("_row")

    def reach(c: str, side: str, distance: Column) -> Column:
        near = F.when(distance <= limit, F.col(f"_{side}_edge_{c}")["reading"])
        return F.coalesce(F.col(f"_{side}_{c}"), near)

    full_before = {c: reach(c, "before", position - F.col(f"_before_edge_{c}")["position"])
                   for c in columns}
    full_after = {c: reach(c, "after", F.col(f"_after_edge_{c}")["position"] - position)
                  for c in columns}
    return joined.select(*_filled(sliced.columns, columns, directions, full_before, full_after))


def _edges(pieces: DataFrame, columns: Sequence[str], in_piece) -> DataFrame:
    """Per piece of a long series: its start, and the nearest readings outside of it."""
    piece = ["_series", "_piece"]
    numbered = pieces.select(*piece, *columns, F.row_number().over(in_piece).alias("_row"))

    def reading(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(
            F.col("_row").cast("bigint").alias("position"), F.col(c).alias("reading")))

    per_piece = numbered.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min(reading(c)).alias(f"_first_{c}") for c in columns],
        *[F.max(reading(c)).alias(f"_last_{c}") for c in columns])
    along = Window.partitionBy("_series").orderBy("_piece")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # a frame that only grows is summed up in one pass, so the later pieces are read backwards
    later = Window.partitionBy("_series").orderBy(F.desc("_piece")).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = per_piece.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))

    def in_series(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct(
            (F.col("_start") + F.col(name)["position"]).alias("position"),
            F.col(name)["reading"].alias("reading")))

    placed = placed.select(
        *piece, "_start",
        *[in_series(f"_{end}_{c}").alias(f"_{end}_{c}") for c in columns
          for end in ("first", "last")])
    return placed.select(
        *piece, "_start",
        *[F.max(f"_last_{c}").over(earlier).alias(f"_before_edge_{c}") for c in columns],
        *[F.min(f"_first_{c}").over(later).alias(f"_after_edge_{c}") for c in columns])


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                suffix: str = "_mean") -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}{suffix}") for c in columns])


def with_group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     suffix: str = "_mean", spread: Sequence[str] | None = None) -> DataFrame:
    """Add the mean of the row's group. Computed as an aggregate and joined back, because a
    window over the group would bring all its rows into one task."""
    means = durable(group_means(df, keys, columns, suffix))
    return attach(df, means, keys, "left", spread, nulls_match=True)


def impute(df: DataFrame, series: SeriesKey, columns: Sequence[str], limit: int = 15,
           fallback: Sequence[str] = (), rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Forward fill, backward fill, then the mean of the filled column per ``fallback`` key."""
    filled = bounded_fill(nullify_nan(df, columns), series, columns, limit,
                          rows_per_slice=rows_per_slice)
    if not fallback:
        return filled
    spread = [*series.keys, series.time, series.tiebreak]
    means = durable(group_means(filled, fallback, columns, "__mean"))
    joined = attach(filled, means, fallback, "left", spread, nulls_match=True)
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"{c}__mean")).alias(c) if c in columns else F.col(c)
        for c in df.columns])
