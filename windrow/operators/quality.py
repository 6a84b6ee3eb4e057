"""Counts, audits and expectations, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.operators.quantiles import exact_percentiles  # noqa: F401


def _nan_test(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.isnan(F.col(name))
    return F.lit(False)


def wide_to_rows(df: DataFrame, names: Sequence[str], label: str,
                 fields: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One row with many columns to one row per name.

    ``fields`` maps each output column to ``{name: input column}``.
    """
    entries = [F.struct(F.lit(n).alias(label), *[F.col(src[n]).alias(out)
                                                 for out, src in fields.items()])
               for n in names]
    return df.select(F.inline(F.array(*entries)))


def missing_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, NaNs and the missing fraction of every column."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_null{i}") for i, c in enumerate(names)],
        *[F.count(F.when(_nan_test(df, c), 1)).alias(f"_nan{i}") for i, c in enumerate(names)])
    rows = wide_to_rows(counted, names, "column_name", {
        "n_rows": {c: "_rows" for c in names},
        "n_null": {c: f"_null{i}" for i, c in enumerate(names)},
        "n_nan": {c: f"_nan{i}" for i, c in enumerate(names)}})
    missing = F.try_divide((F.col("n_null") + F.col("n_nan")).cast("double"), F.col("n_rows"))
    return rows.withColumn("missing_fraction", missing)


@dataclass(frozen=True)
class Expectation:
    """A named number with the interval it has to lie in; ``None`` leaves a side open."""

    name: str
    observed: Column
    lowest: float | None = None
    highest: float | None = None

    @staticmethod
    def row_count(lowest: float | None = None, highest: float | None = None) -> "Expectation":
        return Expectation("row_count", F.count(F.lit(1)), lowest, highest)

    @staticmethod
    def no_nulls(column: str) -> "Expectation":
        return Expectation(f"nulls_{column}", F.count(F.when(F.col(column).isNull(), 1)), 0, 0)

    @staticmethod
    def null_fraction(column: str, lowest: float | None, highest: float | None) -> "Expectation":
        share = F.avg(F.when(F.col(column).isNull(), 1.0).otherwise(0.0))
        return Expectation(f"null_fraction_{column}", share, lowest, highest)

    @staticmethod
    def distinct(column: str, lowest: float | None = None, highest: float | None = None,
                 approximate: bool = False) -> "Expectation":
        count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
        return Expectation(f"distinct_{column}", count, lowest, highest)

    @staticmethod
    def column_count(df: DataFrame, lowest: int) -> "Expectation":
        return Expectation("column_count", F.max(F.lit(len(df.columns))), lowest, None)


class ExpectationError(ValueError):
    """Raised by :func:`require` with the checks that failed."""


def expectations(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """All checks in one aggregate: rows (check_name, observed, lowest, highest, passed)."""
    counted = df.agg(*[c.observed.cast("double").alias(f"_c{i}") for i, c in enumerate(checks)])
    entries = [F.struct(F.lit(c.name).alias("check_name"), F.col(f"_c{i}").alias("observed"),
                        F.lit(c.lowest).cast("double").alias("lowest"),
                        F.lit(c.highest).cast("double").alias("highest"))
               for i, c in enumerate(checks)]
    above = F.coalesce(F.col("observed") >= F.col("lowest"), F.col("lowest").isNull())
    below = F.coalesce(F.col("observed") <= F.col("highest"), F.col("highest").isNull())
    return (counted.select(F.inline(F.array(*entries)))
            .withColumn("passed", F.col("observed").isNotNull() & above & below))


def require(report: DataFrame) -> DataFrame:
    """Raise if a check of an :func:`expectations` report failed; the report otherwise."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise ExpectationError("; ".join(
            f"{r.check_name}: {r.observed} outside [{r.lowest}, {r.highest}]" for r in failed))
    return report


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, keys: Sequence[str], name: str = "n_distinct",
                   approximate: bool = False) -> DataFrame:
    """Distinct key combinations; a combination with a null counts, as in ``distinct()``."""
    combination = F.struct(*keys)
    count = F.approx_count_distinct(F.xxhash64(*keys)) if approximate else (
        F.count_distinct(combination))
    return df.agg(count.alias(name))


def series_summary(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Facts about a table as (metric, value) rows: rows, columns, distinct keys, ranges."""
    facts = {"rows": F.count(F.lit(1)), "columns": F.max(F.lit(len(df.columns)))}
    facts.update({f"distinct_{k}": F.count_distinct(k) for k in keys})
    for c in columns:
        facts[f"min_{c}"], facts[f"max_{c}"] = F.min(c), F.max(c)
    one = df.agg(*[v.cast("double").alias(k) for k, v in facts.items()])
    return wide_to_rows(one, list(facts), "metric", {"value": {k: k for k in facts}})


def summary(df: DataFrame, columns: Sequence[str],
            statistics: Sequence[str] = ("min", "25%", "50%", "75%", "max")) -> DataFrame:
    """Spark's summary with approximate percentiles."""
    return df.select(*columns).summary(*statistics)
