"""Classification reports from the counts of (label, prediction) pairs.

A prediction table is reduced once, with map-side combining, to at most one row per pair of
classes. All metrics are computed from those cells, whatever the number of predictions was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.numeric import chi2_tail, ratio_or, ratio_or_zero


def confusion_cells(predictions: DataFrame, label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """Non-empty cells: (label, prediction, n)."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classes_seen(cells: DataFrame) -> DataFrame:
    """Classes that occur as truth or as prediction."""
    return cells.select(F.explode(F.array("label", "prediction")).alias("class")).distinct()


def per_class(cells: DataFrame) -> DataFrame:
    """Per class: support (rows of the class), predicted (rows given to it), hits."""
    return by_class(cells).groupBy("class").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("support", "predicted", "hits")])


def by_class(cells: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Each cell once for its label and once for its prediction."""
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def counted(name: str, support: Column, predicted: Column, right: Column) -> Column:
        return F.struct(F.col(name).alias("class"), support.alias("support"),
                        predicted.alias("predicted"), right.cast("bigint").alias("hits"))

    return cells.select(*also, F.inline(F.array(
        counted("label", F.col("n"), none, hits), counted("prediction", none, F.col("n"), none))))


def confusion_matrix(cells: DataFrame) -> DataFrame:
    """Every pair of classes seen, with its count and its share of the label's rows.

    The empty pairs are part of the report, so each class is paired with the list of classes.
    """
    classes = classes_seen(cells)
    listed = classes.agg(F.collect_list("class").alias("all")).scalar()
    grid = classes.select(F.col("class").alias("label"),
                          F.explode(listed).alias("prediction"))
    filled = grid.join(cells, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))
    row = F.sum("n").over(Window.partitionBy("label"))
    return filled.select("label", "prediction", "n",
                         ratio_or_zero(F.col("n"), row).alias("normalised"))


def _scores() -> tuple[Column, Column, Column]:
    precision = ratio_or_zero(F.col("hits"), F.col("predicted"))
    recall = ratio_or_zero(F.col("hits"), F.col("support"))
    f1 = ratio_or_zero(2 * F.col("hits"), F.col("predicted") + F.col("support"))
    return precision, recall, f1


def class_report(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, weakest class first.

    A class never predicted or never true has 0 for the undefined ratio.
    """
    precision, recall, f1 = _scores()
    return per_class(cells).select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"),
        "support").orderBy("f1_score", "class")


def overall_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, support-weighted precision, recall and F1, macro F1, kappa and MCC, in one row."""
    precision, recall, f1 = _scores()
    n = F.sum("support").cast("double")
    hits = F.sum("hits").cast("double")
    support, predicted = F.col("support").cast("double"), F.col("predicted").cast("double")

    def weighted(score: Column) -> Column:
        return F.sum(score * support) / n

    sums = per_class(cells).agg(
        n.cast("bigint").alias("n_rows"),
        (hits / n).alias("accuracy"),
        weighted(precision).alias("precision_weighted"),
        weighted(recall).alias("recall_weighted"),
        weighted(f1).alias("f1_weighted"),
        F.avg(f1).alias("f1_macro"),
        (F.sum(support * predicted) / (n * n)).alias("_chance"),
        (F.sum(support * support) / (n * n)).alias("_truth"),
        (F.sum(predicted * predicted) / (n * n)).alias("_guess"))
    # with shares instead of counts: po - pe over 1 - pe, and over the geometric mean
    gain = F.col("accuracy") - F.col("_chance")
    spread = F.sqrt((1 - F.col("_truth")) * (1 - F.col("_guess")))
    return sums.select(
        "n_rows", "accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro",
        ratio_or(gain, 1 - F.col("_chance"), None).alias("cohen_kappa"),
        ratio_or_zero(gain, spread).alias("mcc"))


def mcnemar(first: DataFrame, second: DataFrame, row_id: str, correction: bool = True,
            names: tuple[str, str] = ("A", "B"), label: str = "label",
            prediction: str = "prediction", level: float = 0.05) -> DataFrame:
    """Paired test of two classifiers on the same rows, matched by row id.

    b00 both right, b01 only the first right, b10 only the second right, b11 both wrong. Rows that
    only one table has are counted as n_only_a and n_only_b, and those without an id, or paired
    without a label or prediction, as n_null; an id that one table has twice is an error.
    """
    def marked(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.select(F.col(row_id).alias("_id"), (F.col(prediction) == F.col(label)).alias(own),
                         F.lit(None).cast("boolean").alias(other),
                         F.lit(1).alias(f"n_{own}"), F.lit(0).alias(f"n_{other}"))
    both = marked(first, "a", "b").unionByName(marked(second, "b", "a"))
    known = both.filter("_id is not null").groupBy("_id").agg(
        F.max("a").alias("a"), F.max("b").alias("b"), F.sum("n_a").alias("n_a"),
        F.sum("n_b").alias("n_b"))
    unknown = both.filter("_id is null").select("_id", "a", "b", *[
        F.col(c).cast("bigint").alias(c) for c in ("n_a", "n_b")])
    rows = known.unionByName(unknown)
    a, b, paired = F.col("a"), F.col("b"), (F.col("n_a") > 0) & (F.col("n_b") > 0)

    def times(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    counted = rows.agg(
        times(a & b).alias("b00"), times(a & ~b).alias("b01"),
        times(~a & b).alias("b10"), times(~a & ~b).alias("b11"),
        times((F.col("n_b") == 0) & F.col("_id").isNotNull()).alias("n_only_a"),
        times((F.col("n_a") == 0) & F.col("_id").isNotNull()).alias("n_only_b"),
        times(F.col("_id").isNull() | (paired & (a.isNull() | b.isNull()))).alias("n_null"),
        F.coalesce(F.max(F.greatest("n_a", "n_b")), F.lit(0)).alias("_most"))
    table = counted.withColumn("b00", F.when(F.col("_most") <= 1, F.col("b00")).otherwise(
        F.raise_error(F.lit(f"{row_id} is not unique in a prediction table")).cast("bigint")))
    differing = F.col("b01") + F.col("b10")
    gap = F.abs(F.col("b01") - F.col("b10")) - (1 if correction else 0)
    tested = table.withColumn("statistic", ratio_or_zero(gap * gap, differing))
    p_value = F.when(differing == 0, F.lit(1.0)).otherwise(chi2_tail(F.col("statistic")))
    return tested.select(
        F.lit(names[0]).alias("model_a"), F.lit(names[1]).alias("model_b"),
        "b00", "b01", "b10", "b11", "n_only_a", "n_only_b", "n_null", "statistic",
        p_value.alias("p_value"), F.when(p_value < level, "significant").otherwise("not significant").alias("decision"))
