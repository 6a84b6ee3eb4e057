"""Attaching small tables to large ones without assuming that small tables stay small."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
MOST_TRACKED = 1_000_000     # items that Spark's frequency sketch can follow


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(0)
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wrapped = F.struct(col)
            size = size + F.coalesce(F.octet_length(F.to_json(wrapped)), F.lit(0)) + 16
        else:
            size = size + 8
    return size.cast("bigint")


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure, rather than assume, that ``table`` may be sent to every executor.

    Every task adds up its own rows, and two numbers reach the driver. A table that is dear to
    compute should be durable before it is measured and joined.
    """
    n, total = table.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(table)), F.lit(0))).first()
    return n <= rows and total <= size


def key_hash(df: DataFrame, on: Sequence[str], like: DataFrame | None = None) -> Column:
    """Equal for keys that a join takes as equal; of the types that ``like`` has, where given."""
    parts = []
    for k in on:
        kind = (df if like is None else like).schema[k].dataType
        col = F.col(k) if df.schema[k].dataType == kind else F.col(k).try_cast(kind)
        # negative zero joins with zero
        parts.append(col + F.lit(0.0).cast(kind) if isinstance(
            kind, (T.DoubleType, T.FloatType)) else col)
    return F.xxhash64(*parts)


def hot_keys(rows: DataFrame, on: Sequence[str], parts: int | None = None) -> dict[int, int]:
    """Pieces for each key that is more than an even part of the rows, by :func:`key_hash`.

    The table is thought of as ``parts`` even parts, by default as many as a shuffle has. Keys are
    counted by a frequency sketch that every task fills for itself; a key above one part gets as
    many pieces as it fills parts. So there are fewer hot keys than parts, and all pieces together
    are fewer than twice the parts.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(MOST_TRACKED, max(1024, 32 * parts))
    found, total = rows.select(key_hash(rows, on).alias("h")).agg(
        F.expr(f"approx_top_k(h, {min(parts, tracked)}, {tracked})"), F.count(F.lit(1))).first()
    each = max(1, -(-total // parts))
    return {r["item"]: -(-r["count"] // each) for r in found or [] if r["count"] > each}


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
           spread: Sequence[str] | None = None, small: bool | None = None,
           nulls_match: bool = False, parts: int | None = None) -> DataFrame:
    """Equi-join ``rows`` with a lookup or statistics ``table`` that has one row per key.

    A table measured to be small is broadcast, and the rows are not shuffled. A larger one is
    joined by shuffle with the hot keys of ``rows`` spread over pieces: their rows by a hash of the
    ``spread`` columns (all columns by default), their table row copied to each piece. ``small``
    passes on a measurement the caller has already made. ``nulls_match`` treats null as a key like
    any other, the way grouping does.
    """
    if small is None:
        small = is_small(table)
    if small:
        return join_rows(rows, F.broadcast(table), on, how, nulls_match)
    return spread_join(rows, table, on, how, spread, nulls_match, parts)


def spread_join(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
                spread: Sequence[str] | None = None, nulls_match: bool = False,
                parts: int | None = None) -> DataFrame:
    """The shuffle path of :func:`attach`; correct for a table of any size and any key skew.

    A key that nothing matches, null included, is spread like any other hot one.
    """
    hot = hot_keys(rows.select(*on), on, parts)
    if not hot:
        return join_rows(rows, table, on, how, nulls_match)
    # fewer rows than the shuffle has partitions
    listed = F.broadcast(rows.sparkSession.createDataFrame(
        list(hot.items()), "_hash bigint, _pieces bigint"))

    def dealt(df: DataFrame, piece: Column) -> DataFrame:
        return (df.withColumn("_hash", key_hash(df, on, like=rows)).join(listed, "_hash", "left")
                .withColumn("_piece", piece).drop("_hash", "_pieces"))
    own = F.pmod(F.xxhash64(*(spread or rows.columns)), F.col("_pieces"))
    left = dealt(rows, F.coalesce(own, F.lit(0).cast("bigint")))
    right = dealt(table, F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.coalesce("_pieces", F.lit(1).cast("bigint")) - 1)))
    return join_rows(left, right, [*on, "_piece"], how, nulls_match).drop("_piece")


def join_rows(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str, nulls_match: bool
              ) -> DataFrame:
    """Equi-join with one column per key; ``nulls_match`` as in :func:`attach`."""
    if not nulls_match:
        return rows.join(table, list(on), how).select(
            *rows.columns, *_extra(rows, table, on, how))
    renamed = table.withColumnsRenamed({k: f"_key_{k}" for k in on})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in on])
    return rows.join(renamed, same, how).select(*rows.columns, *_extra(rows, table, on, how))


def _extra(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str) -> list[str]:
    return [] if how in ("left_semi", "left_anti") else [
        c for c in table.columns if c not in on]
