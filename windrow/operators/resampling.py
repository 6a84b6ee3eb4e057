"""Bootstrap intervals from confusion cells.

Accuracy and F1 depend on a resample only through its cell counts, so rows are never resampled:
each replicate draws a count per cell. The work is classes x classes x replicates, whatever the
number of predictions. Draws are Poisson with the cell count as mean (the Poisson bootstrap,
summed over the rows of a cell), taken by inverting a hash of (cell, replicate, seed), so that
they do not depend on partitions or retries. The inversion is exact at every mean: the distribution
function of a cell and its draws are sorted together, and a draw's count is read off the last step
below it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.hashing import hash_fraction
from windrow.functions.numeric import poisson_pmf, ratio_or_zero
from windrow.operators.evaluation import by_class, overall_metrics
from windrow.operators.quality import wide_to_rows

METRICS = ("accuracy", "f1_weighted")
DEVIATIONS = 10        # of the mean to each side; what lies beyond is below 1e-20
LEAST_CHANCE = 1e-10


def poisson_quantiles(means: DataFrame, draws: DataFrame, by: Sequence[str], mean: str, u: str,
                      name: str) -> DataFrame:
    """Add to ``draws`` the smallest k with P(Poisson(mean) <= k) >= u, for 0 < u < 1.

    ``means`` has one row per ``by``. The steps of a mean are as many as some of its standard
    deviations, so they grow with its square root. A mean of 0 or below draws 0.
    """
    reach = F.ceil(DEVIATIONS * F.sqrt(F.col(mean))) + 60
    steps = means.filter(F.col(mean) > 0).select(*by, mean, F.explode(F.sequence(
        F.greatest(F.floor(F.col(mean)) - reach, F.lit(0).cast("bigint")),
        F.ceil(F.col(mean)) + reach)).alias("_k"))
    upto = Window.partitionBy(*by).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    chances = steps.select(*by, F.sum(poisson_pmf(F.col("_k"), F.col(mean))).over(upto).alias("_at"),
                           "_k")
    rest = [c for c in draws.columns if c not in by]
    both = draws.select(*by, F.col(u).alias("_at"), F.struct(*rest).alias("_draw")).unionByName(
        chances, allowMissingColumns=True)
    # a draw stands before a step of its own height
    along = Window.partitionBy(*by).orderBy("_at", F.col("_k").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    below = F.coalesce(F.max("_k").over(along) + 1, F.lit(0)).cast("bigint")
    return both.withColumn(name, below).filter("_draw is not null").select(*by, "_draw.*", name)


def replicate_cells(cells: DataFrame, replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(replicate, label, prediction, n) with drawn counts."""
    by = ["label", "prediction"]
    drawn = F.least(F.greatest(hash_fraction(*by, "replicate", seed=seed), F.lit(LEAST_CHANCE)),
                    F.lit(1 - LEAST_CHANCE))
    draws = cells.select(*by, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
    means = cells.select(*by, F.col("n").cast("double").alias("mean"))
    return poisson_quantiles(means, draws.withColumn("u", drawn), by, "mean", "u", "n").select(
        "replicate", *by, "n")


def replicate_metrics(drawn: DataFrame) -> DataFrame:
    """Accuracy and weighted F1 of every replicate."""
    classes = by_class(drawn, ["replicate"]).groupBy("replicate", "class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    f1 = ratio_or_zero(2 * F.col("hits"), F.col("predicted") + F.col("support"))
    n = F.sum("support")
    return classes.groupBy("replicate").agg(
        ratio_or_zero(F.sum("hits"), n).alias("accuracy"),
        ratio_or_zero(F.sum(f1 * F.col("support")), n).alias("f1_weighted"))


def bootstrap_intervals(cells: DataFrame, replicates: int = 1000, alpha: float = 0.05,
                        seed: int = 42) -> DataFrame:
    """Percentile interval per metric: (metric, observed, ci_lower, ci_upper, n_boot)."""
    metrics = replicate_metrics(replicate_cells(cells, replicates, seed))
    # one number per replicate: the exact percentile aggregate is bounded here
    bounds = metrics.agg(*[
        F.percentile(m, F.lit(p)).alias(f"{m}_{side}")
        for m in METRICS for side, p in (("lo", alpha / 2), ("hi", 1 - alpha / 2))])
    observed = overall_metrics(cells).select(F.struct(*METRICS)).scalar()
    one = bounds.select("*", observed.alias("_seen")).select(
        "*", *[F.col("_seen")[m].alias(f"{m}_seen") for m in METRICS])
    return wide_to_rows(one, METRICS, "metric", {
        "observed": {m: f"{m}_seen" for m in METRICS},
        "ci_lower": {m: f"{m}_lo" for m in METRICS},
        "ci_upper": {m: f"{m}_hi" for m in METRICS},
    }).withColumn("n_boot", F.lit(replicates))
