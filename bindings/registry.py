"""Registration, table access and the rounding shared by queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Small enough that the sliced paths, not only the simple ones, are what gets compared.
SLICE_ROWS = 2_000


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL it has to agree with."""
    def add(function):
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _nudge(digits: int) -> float:
    return float(f"1e-{digits + 3}")


def near(col: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison. The nudge keeps exact ties from rounding differently per engine."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col + F.lit(_nudge(digits)), digits)


def near_sql(expression: str, digits: int = 6) -> str:
    return f"round(({expression}) + {_nudge(digits)!r}, {digits})"


def near_all(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.select(*[near(c, digits).alias(c) if c in columns else F.col(c)
                       for c in df.columns])


def fraction_sql(*keys: str, seed: int = 42) -> str:
    joined = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"(CAST('0x' || substr(md5(concat_ws('#', {joined}, '{seed}')), 1, 8) AS BIGINT)"
            " / 4294967296.0)")
