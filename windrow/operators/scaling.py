"""Fitted scaling: statistics are a one-row table, so they can be fitted on one side of a split.

The statistics reach the rows as a scalar subquery: they are never collected to the driver, and
there is no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.missing import null_if_nan

STD_FLOOR = 1e-8


def _with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    return df.select("*", one_row.select(F.struct("*")).scalar().alias("_fit"))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``{c}_lo`` and ``{c}_hi`` of every column, NaN and null left out."""
    clean = {c: null_if_nan(F.col(c).cast("double")) for c in columns}
    return df.agg(*[F.min(v).alias(f"{c}_lo") for c, v in clean.items()],
                  *[F.max(v).alias(f"{c}_hi") for c, v in clean.items()])


def apply_minmax(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale to [0, 1]; a column without a spread becomes 0.0 in every row, null or not."""
    def scaled(c: str) -> Column:
        lo, hi = F.col("_fit")[f"{c}_lo"], F.col("_fit")[f"{c}_hi"]
        flat = lo.isNull() | hi.isNull() | (lo == hi)
        return F.when(flat, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo))

    return _with_row(df, fitted).select(*[
        scaled(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_minmax(df, fit_minmax(df, columns), columns)


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``{c}_mu`` and ``{c}_sd`` (population); a tiny deviation counts as 1."""
    def deviation(c: str) -> Column:
        sd = F.stddev_pop(c)
        return F.when(sd < STD_FLOOR, F.lit(1.0)).otherwise(sd)

    return df.agg(*[F.avg(c).alias(f"{c}_mu") for c in columns],
                  *[deviation(c).alias(f"{c}_sd") for c in columns])


def apply_zscore(df: DataFrame, fitted: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _with_row(df, fitted).select(*[
        ((F.col(c) - F.col("_fit")[f"{c}_mu"]) / F.col("_fit")[f"{c}_sd"]).alias(c)
        if c in columns else F.col(c) for c in df.columns])


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_zscore(df, fit_zscore(df, columns), columns)
