"""Samples and splits fixed by a hash of the row key.

Spark's own sampling depends on the partition layout: the same seed gives other rows on another
number of cores. Here membership is a function of key, seed and share only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.hashing import hash_fraction
from windrow.operators.joins import attach, is_small

ROWS_PER_BIN = 10_000


def stable_sample(df: DataFrame, key: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    return df.filter(hash_fraction(*key, seed=seed) < share)


def mark_split(df: DataFrame, key: Sequence[str], train: float = 0.8, seed: int = 42,
               name: str = "in_train") -> DataFrame:
    """Add whether the row is on the training side.

    With the key of the row this is a row-level split; with the key of a subject all rows of a
    subject fall on the same side.
    """
    return df.withColumn(name, hash_fraction(*key, seed=seed) < train)


def split(df: DataFrame, key: Sequence[str], train: float = 0.8, seed: int = 42
          ) -> tuple[DataFrame, DataFrame]:
    """Disjoint and complete (train, test)."""
    side = hash_fraction(*key, seed=seed) < train
    return df.filter(side), df.filter(~side)


def mark_stratified(df: DataFrame, label: str, key: str, train: float = 0.8, seed: int = 42,
                    name: str = "in_train", bins: int | None = None) -> DataFrame:
    """Put exactly round(train x size) rows of every class on the training side; null is a class.

    Per class the rows with the smallest (hash, key) train. The rows are not ranked: counts per
    hash bin find the bin in which the last training row lies, only that bin is ordered to find
    the row itself, and every row is then compared with it. ``key`` is unique. The number of bins
    follows from the table, so that a bin holds about ``ROWS_PER_BIN`` rows at most.
    """
    if bins is None:
        bins = max(1, math.ceil(df.count() / ROWS_PER_BIN))
    hashed = df.withColumn("_h", hash_fraction(key, seed=seed))
    rows = hashed.select(F.col(label), "_h", F.col(key),
                         F.floor(F.col("_h") * bins).cast("int").alias("_bin"))
    counts = rows.groupBy(label, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(label)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.select(
        label, "_bin", "_n", F.sum("_n").over(upto).alias("_upto"),
        F.round(F.sum("_n").over(whole) * F.lit(train)).cast("bigint").alias("_want"))
    last_bin = placed.filter((F.col("_upto") >= F.col("_want"))
                             & (F.col("_upto") - F.col("_n") < F.col("_want"))).select(
        label, "_bin", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need"))
    small = is_small(df.select(label).distinct())
    candidates = attach(rows, last_bin, [label, "_bin"], "inner", [key], small, nulls_match=True)
    ordered = Window.partitionBy(label).orderBy("_h", key)
    last_row = (candidates.withColumn("_r", F.row_number().over(ordered))
                .filter(F.col("_r") == F.col("_need"))
                .select(label, F.struct("_h", key).alias("_last")))
    marked = attach(hashed, last_row, [label], "left", [key], small, nulls_match=True)
    inside = F.coalesce(F.struct("_h", key) <= F.col("_last"), F.lit(False))
    return marked.select(*df.columns, inside.alias(name))


def repeated_splits(df: DataFrame, key: Sequence[str], seeds: Iterable[int], train: float = 0.8
                    ) -> list[tuple[int, DataFrame, DataFrame]]:
    """(seed, train, test) for several seeds, over one input."""
    return [(seed, *split(df, key, train, seed)) for seed in seeds]
