"""One-vs-rest ROC curves, their area, and the macro average.

Scores are reduced to one row per distinct (class, score) before anything is ordered; the
cumulative counts are running sums over slices of the score, so a class with most of the rows is
not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.numeric import ratio_or
from windrow.operators.joins import is_small
from windrow.operators.ordering import ROWS_PER_SLICE, cut_points, running_sums, slice_of
from windrow.session import durable

GRID = 200


def one_vs_rest(predictions: DataFrame, label: str, scores: str) -> DataFrame:
    """(class, score, hit) per row and class; class ``i`` is element ``i`` of ``scores``."""
    long = predictions.select(F.col(label).alias("_label"),
                              F.posexplode(scores).alias("class", "score"))
    return long.select("class", "score", (F.col("_label") == F.col("class")).alias("hit"))


def score_counts(long: DataFrame) -> DataFrame:
    """Rows inside and outside of the class at each distinct score."""
    return long.groupBy("class", F.col("score").cast("double").alias("score")).agg(
        F.count(F.when(F.col("hit"), 1)).alias("pos"),
        F.count(F.when(~F.col("hit"), 1)).alias("neg"))


def cumulative_counts(long: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(class, score, pos, neg, tp, fp, n_pos, n_neg), counted from the highest score down.

    The predictions are read once, to count the rows at each distinct score. The result is durable:
    points, areas and the macro curve all start from it.
    """
    counts = durable(score_counts(long).withColumn("_down", -F.col("score")))
    cuts, _ = cut_points(counts, "_down", rows_per_slice)
    sliced = slice_of(counts, "_down", cuts, "_slice") if cuts else counts
    summed = running_sums(sliced, ["class"], [F.col("_down")], {"tp": "pos", "fp": "neg"},
                          "_slice" if cuts else None)
    sizes = counts.groupBy("class").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return durable(summed.join(F.broadcast(sizes) if is_small(sizes) else sizes, "class").select(
        "class", "score", "pos", "neg", "tp", "fp", "n_pos", "n_neg"))


def roc_points(cumulative: DataFrame) -> DataFrame:
    """(class, fpr, tpr, threshold) at every distinct score, and the start at (0, 0)."""
    points = cumulative.select(
        "class", ratio_or(F.col("fp"), F.col("n_neg"), None).alias("fpr"),
        ratio_or(F.col("tp"), F.col("n_pos"), None).alias("tpr"),
        F.col("score").alias("threshold"))
    start = cumulative.select("class").distinct().select(
        "class", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
        F.lit(None).cast("double").alias("threshold"))
    return points.unionByName(start)


def auc(cumulative: DataFrame) -> DataFrame:
    """Trapezoid area per class; null for a class with only one kind of row."""
    # the step at a score is neg wide and runs from tp - pos up to tp
    step = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    area = F.sum(step).cast("double") / 2.0
    return cumulative.groupBy("class").agg(
        F.max("n_pos").alias("n_pos"), F.max("n_neg").alias("n_neg"), area.alias("_area")
    ).select("class", "n_pos", "n_neg", F.try_divide(
        F.col("_area"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"))


def macro_roc(cumulative: DataFrame, grid: int = GRID) -> DataFrame:
    """Mean over the classes of tpr interpolated at ``grid`` evenly spaced fpr: (step, fpr, tpr).

    Points are first reduced to the extreme ones per grid interval, so that the interpolation
    works on at most ``grid`` rows per class. Where several points share an fpr, the left
    neighbour is the highest of them and the right neighbour the lowest. A class without an
    outside or an inside has no curve and is left out.
    """
    last = grid - 1
    usable = cumulative.filter((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
    fpr, tpr = F.col("fp") / F.col("n_neg"), F.col("tp") / F.col("n_pos")
    point = F.struct(fpr.alias("fpr"), tpr.alias("tpr"))
    # first grid step at or right of the point, in whole numbers
    step = F.call_function("div", F.col("fp") * last + F.col("n_neg") - 1, F.col("n_neg"))
    extremes = usable.select("class", step.cast("int").alias("step"), point.alias("point")).groupBy(
        "class", "step").agg(F.max("point").alias("top"), F.min("point").alias("bottom"))
    origin = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    frame = (extremes.select("class").distinct()
             .select("class", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("step")))
    at = frame.join(extremes, ["class", "step"], "left")
    along = Window.partitionBy("class").orderBy("step")
    left = F.coalesce(F.max("top").over(along.rowsBetween(Window.unboundedPreceding, 0)), origin)
    right = F.min("bottom").over(along.rowsBetween(1, Window.unboundedFollowing))
    bracketed = at.select("step", (F.col("step") / F.lit(float(last))).alias("fpr"),
                          left.alias("l"), right.alias("r"))
    slope = ratio_or(F.col("r.tpr") - F.col("l.tpr"), F.col("r.fpr") - F.col("l.fpr"), 0.0)
    value = F.col("l.tpr") + F.coalesce(slope * (F.col("fpr") - F.col("l.fpr")), F.lit(0.0))
    return bracketed.groupBy("step", "fpr").agg(F.avg(value).alias("tpr"))


def curve_area(curve: DataFrame, order: str = "step") -> DataFrame:
    """Trapezoid area under a report-sized curve of (step, fpr, tpr)."""
    along = Window.orderBy(order)
    width = F.col("fpr") - F.lag("fpr").over(along)
    height = (F.col("tpr") + F.lag("tpr").over(along)) / 2.0
    return curve.select((width * height).alias("_a")).agg(F.sum("_a").alias("auc"))


def roc_report(cumulative: DataFrame, names: Column | None = None, grid: int = GRID
               ) -> DataFrame:
    """All curves and the macro average in one table: class, fpr, tpr, threshold, auc."""
    text = F.col("class").cast("string") if names is None else names
    curves = roc_points(cumulative).join(auc(cumulative).select("class", "auc"), "class").select(
        text.alias("class"), "fpr", "tpr", "threshold", "auc")
    macro = macro_roc(cumulative, grid)
    averaged = macro.select(
        F.lit("MACRO_AVG").alias("class"), "fpr", "tpr",
        F.lit(None).cast("double").alias("threshold"), curve_area(macro).scalar().alias("auc"))
    return curves.unionByName(averaged)
