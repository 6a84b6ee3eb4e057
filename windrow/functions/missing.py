"""Missing values: NaN is a number to Spark, so it is turned into null once, at ingest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_if_nan(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def nan_to(col: Column, value: float = 0.0) -> Column:
    """NaN becomes ``value``; null stays null."""
    return F.when(F.isnan(col), F.lit(value)).otherwise(col)


def present(col: Column) -> Column:
    """Neither null nor NaN; never null itself."""
    return col.isNotNull() & ~F.isnan(col)


def floating(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    wanted = set(df.columns if columns is None else columns)
    return [f.name for f in df.schema.fields
            if f.name in wanted and isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nullify_nan(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN to null in all floating columns (or those given), in one projection."""
    targets = set(floating(df, columns))
    return df.select(*[
        null_if_nan(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns
    ])
