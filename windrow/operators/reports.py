"""Report tables: one row per model, run or configuration. All inputs here are report-sized."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.numeric import ratio_or
from windrow.functions.text import bracket_number

COMPARISON_COLUMNS = ("model", "input_type", "hardware", "accuracy", "f1_weighted", "f1_macro",
                      "training_time_s", "gpu_memory_mb", "source")
SCALING_COLUMNS = ("scaling_type", "cores", "n_cores", "fraction", "rows", "train_rows",
                   "train_sec", "accuracy", "f1_weighted", "speedup")


def run_statistics(runs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, minimum, maximum and range of each metric over runs."""
    long = runs.select([F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [], list(metrics), "metric", "value")
    return long.groupBy("metric").agg(
        F.count("value").alias("n_runs"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), (F.max("value") - F.min("value")).alias("range"))


def best_row(results: DataFrame, metric: str, name: str) -> DataFrame:
    """The row with the highest metric; the first name wins a tie."""
    return top_rows(results, metric, name, 1)


def top_rows(results: DataFrame, metric: str, name: str, k: int = 20) -> DataFrame:
    return results.orderBy(F.col(metric).desc(), F.col(name).asc()).limit(k)


def with_cores(results: DataFrame) -> DataFrame:
    """Add the core count written in a master setting such as ``local[4]``."""
    if "n_cores" in results.columns:
        return results
    return results.withColumn("n_cores", bracket_number(F.col("cores")))


def _speedup(base: Column) -> Column:
    own = F.col("train_sec")
    return F.when(own > 0, F.round(ratio_or(base, own, 0.0), 2)).otherwise(F.lit(0.0))


def _fewest_cores(over: Window) -> Column:
    return F.min_by("train_sec", F.struct("n_cores", "train_sec")).over(over)


def strong_speedup(results: DataFrame) -> DataFrame:
    """Time on one core of the same fraction over own time; own time where that run is missing."""
    same = Window.partitionBy("fraction")
    one_core = F.max(F.when(F.col("n_cores") == 1, F.col("train_sec"))).over(same)
    return with_cores(results).withColumn(
        "speedup", _speedup(F.coalesce(one_core, F.col("train_sec"))))


def weak_efficiency(results: DataFrame) -> DataFrame:
    """Time of the smallest configuration over own time, where work grows with the cores."""
    everything = Window.partitionBy(F.lit(0))
    base = with_cores(results).withColumn("_base", _fewest_cores(everything))
    return base.withColumn("efficiency", _speedup(F.col("_base"))).drop("_base")


def scaling_table(strong: DataFrame, weak: DataFrame | None = None) -> DataFrame:
    """Strong and weak runs in one table, on the columns they share."""
    table = strong_speedup(strong).withColumn("scaling_type", F.lit("strong")).select(
        *SCALING_COLUMNS)
    if weak is None:
        return table
    second = (weak_efficiency(weak).withColumnRenamed("efficiency", "speedup")
              .withColumn("scaling_type", F.lit("weak")).select(*SCALING_COLUMNS))
    return table.unionByName(second)


def add_device_memory(results: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Left join with a (device, gpu_memory_mb) table on the device the hardware text names."""
    device = F.when(F.col("hardware").contains("CUDA"), "cuda").otherwise("cpu")
    measured = benchmark.select("device", "gpu_memory_mb")
    return (results.withColumn("device", device).join(measured, "device", "left")
            .drop("device"))


def scored(results: DataFrame, metric: str = "accuracy", name_contains: str | None = None,
           name: str = "model") -> DataFrame:
    """Rows that have the metric, optionally only those whose name contains a text."""
    kept = results.filter(F.col(metric).isNotNull())
    return kept if name_contains is None else kept.filter(F.col(name).contains(name_contains))


def unified_comparison(sources: Mapping[str, DataFrame],
                       columns: Sequence[str] = COMPARISON_COLUMNS) -> DataFrame:
    """Results of several sources in one table; what a source does not report is null.

    Columns come in the given order, and only those that some source has.
    """
    whole = None
    for name, df in sources.items():
        tagged = df.withColumn("source", F.lit(name))
        tagged = tagged.select(*[c for c in columns if c in tagged.columns])
        whole = tagged if whole is None else whole.unionByName(tagged, allowMissingColumns=True)
    return whole.select(*[c for c in columns if c in whole.columns])
