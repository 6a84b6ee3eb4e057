"""Ordered computations whose groups may be far larger than one task.

Four tools. *Slices* cut an ordered column at its measured quantiles, so that a group can be
processed slice by slice and stitched together from one small record per slice. *Boundaries* cut an
order of several columns at records of the table, so that rows of one instant are cut as well; where
there are many, the table itself is sorted and cut by position.
*Running sums* use slices for cumulative totals. *Dense index* numbers the rows of a globally
sorted table. The number of slices grows with the table; what one holds does not.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.session import durable

ROWS_PER_SLICE = 2_000_000
SAMPLE_PER_SLICE = 2_000
MOST_BOUNDARIES = 200   # that every row is compared with; more slices than that are cut by position
MARGIN = 1.25           # slices cut by a sample are made smaller by this, some ten deviations


def cut_points(df: DataFrame, column: str, rows_per_slice: int = ROWS_PER_SLICE
               ) -> tuple[list[float], int]:
    """Values that cut ``df`` into slices of about ``rows_per_slice`` rows, and that size.

    Two scans of one column; one number per slice comes back to the driver. No cuts for a table
    that fits one slice. Results do not depend on where the cuts lie, so on a large table they
    are taken from a sample, as Spark does for its own range partitions.
    """
    total = df.count()
    slices = math.ceil(total / rows_per_slice)
    if slices <= 1:
        return [], max(total, 1)
    probabilities = [i / slices for i in range(1, slices)]
    share = slices * SAMPLE_PER_SLICE / total
    values = df.select(column) if share >= 1 else df.select(column).sample(share, seed=42)
    cuts = values.approxQuantile(column, probabilities, 1 / (4 * slices))
    return sorted(set(cuts)), math.ceil(total / slices)


def slice_of(df: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    """Add the number of cuts at or below ``column`` as ``name``; 0 where it is null."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    number = Bucketizer(splits=splits, inputCol=column, outputCol="_bucket",
                        handleInvalid="keep").transform(df)
    return number.withColumn(name, F.coalesce(F.col("_bucket"), F.lit(0)).cast("int")).drop("_bucket")


@dataclass(frozen=True)
class Boundaries:
    """Records that cut an order: the distinct values of its first column, and a table of the rest.

    The table has one row per value: its number, the boundaries before it, and the ordered records
    of the other columns at which that value is cut.
    """
    values: list[float]
    table: DataFrame
    most_ties: int


def in_slices(df: DataFrame, first: str, rest: Sequence[str], rows_per_slice: int, name: str
              ) -> DataFrame | None:
    """Add a number as ``name`` that rises with the order and is shared by one slice of rows at most.

    None for a table that fits one slice.
    """
    total = df.count()
    if total <= rows_per_slice:
        return None
    if total > MOST_BOUNDARIES * rows_per_slice:
        return cut_by_position(df, [first, *rest], rows_per_slice, name)
    return slice_between(df, first, rest, boundaries(df, first, rest, rows_per_slice, total), name)


def cut_by_position(df: DataFrame, order: Sequence[str], rows_per_slice: int, name: str) -> DataFrame:
    """Sort ``df`` by range and number the slices of every sorted partition.

    The checkpoint fixes the partitions, so each use of the table sees the same slices. Nothing is
    sent to all tasks, and a row costs the same however many slices there are.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return durable(df.orderBy(*order)).select("*", (
        F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
        + F.call_function("div", row, F.lit(rows_per_slice))).alias(name))


def boundaries(df: DataFrame, first: str, rest: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE,
               total: int | None = None) -> Boundaries | None:
    """Records of ``df`` that cut the order by ``first``, then ``rest``, into slices.

    ``first`` is a double without nulls. No slice holds more than ``rows_per_slice`` rows as long as
    no two rows are equal in the whole order, however many are equal in ``first``. The narrow order
    is sorted, from a sample where the table is large, and every so many records one is a boundary.
    None for a table that fits one slice. ``total`` passes on a count the caller has already made.
    """
    if total is None:
        total = df.count()
    if total <= rows_per_slice:
        return None
    slices = math.ceil(total / rows_per_slice)
    share = slices * SAMPLE_PER_SLICE / total
    narrow = df.select(F.col(first).alias("value"), F.struct(*rest).alias("tie"))
    if share < 1:
        slices = math.ceil(total * MARGIN / rows_per_slice)
        narrow = narrow.sample(share, seed=42)
    placed = dense_index(narrow, ["value", "tie"], "at")
    n = placed.count()
    cut = F.floor(F.col("at") * slices / n) > F.floor((F.col("at") - 1) * slices / n)
    records = placed.filter((F.col("at") > 0) & cut)
    if n and total <= n:                     # exact ranks: a fixed number of rows to each slice
        records = placed.filter((F.col("at") > 0) & (F.col("at") % rows_per_slice == 0))
    # one row per slice at most
    along = Window.orderBy("value")
    table = durable(records.groupBy("value").agg(F.sort_array(F.collect_list("tie")).alias("ties"))
                    .withColumn("number", F.row_number().over(along))
                    .withColumn("before", F.sum(F.size("ties")).over(along) - F.size("ties")))
    found = table.orderBy("number").select("value", F.size("ties")).collect()
    return Boundaries([r[0] for r in found], table, max((r[1] for r in found), default=0))


def slice_between(df: DataFrame, first: str, rest: Sequence[str], cuts: Boundaries, name: str
                  ) -> DataFrame:
    """Add the number of boundaries at or below the row as ``name``."""
    splits = [-math.inf, *cuts.values, math.inf]
    numbered = Bucketizer(splits=splits, inputCol=first, outputCol="_number",
                          handleInvalid="keep").transform(df).withColumn(
        "_number", F.col("_number").cast("int"))
    table = cuts.table.select(F.col("number").alias("_number"), F.col("value").alias("_value"),
                              F.col("ties").alias("_ties"), F.col("before").alias("_before"))
    own = F.struct(*rest)

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.call_function("div", low + high, F.lit(2)).cast("int")
        above = F.get("_ties", middle) <= own
        return F.when(low < high, F.struct(
            F.when(above, middle + 1).otherwise(low).alias("low"),
            F.when(above, high).otherwise(middle).alias("high"))).otherwise(state)
    steps = F.array(*[F.lit(i) for i in range(cuts.most_ties.bit_length() + 1)])
    start = F.struct(F.lit(0).alias("low"), F.size("_ties").alias("high"))
    inside = F.when(F.col(first) > F.col("_value"), F.size("_ties")).otherwise(
        F.aggregate(steps, start, halve, lambda state: state["low"]))
    return numbered.join(F.broadcast(table), "_number", "left").select(
        *df.columns, F.coalesce(F.col("_before") + inside, F.lit(0)).cast("int").alias(name))


def running_sums(df: DataFrame, groups: Sequence[str], order: Sequence[Column],
                 sums: Mapping[str, str], slice_name: str | None = None) -> DataFrame:
    """Add ``{new: cumulative sum of old}`` within ``groups`` in the given order.

    ``slice_name`` is an integer column that rises with the order. Each (group, slice) is summed
    on its own and shifted by the totals of the slices before it; both sides of that join share one
    partitioning.
    """
    if slice_name is None:
        frame = Window.partitionBy(*groups).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(old).over(frame).alias(new) for new, old in sums.items()])
    parts = [*groups, slice_name]
    frame = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*groups).orderBy(slice_name).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = df.groupBy(*parts).agg(*[F.sum(old).alias(f"_t_{new}") for new, old in sums.items()])
    shifts = totals.select(*parts, *[
        F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in sums])
    local = df.select("*", *[F.sum(old).over(frame).alias(f"_l_{new}")
                             for new, old in sums.items()])
    return local.join(shifts, parts).select(
        *df.columns, *[(F.col(f"_l_{new}") + F.col(f"_s_{new}")).alias(new) for new in sums])


def dense_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the global order of ``order`` (a unique combination).

    The table is sorted by range and checkpointed, which fixes its partitions; the row number
    inside the partition plus the size of the partitions before it is the index. Only one row per
    partition is broadcast.
    """
    # the upper bits of the generated id hold the partition, the lower 33 the row inside it
    fixed = durable(df.orderBy(*order)).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("_row"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (fixed.join(F.broadcast(sizes), "_part")
            .select(*df.columns, (F.col("_before") + F.col("_row")).alias(name)))
