"""Small helpers that several operators share.

Operators read the columns they are told to read, under names of their own, so further columns of
a table, whatever they are called, never matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\x0c\r"
FOLDS = 3
HELD_OUT_FOLD = 1


def words(text: Column | str) -> Column:
    """The words of a text, as an array; an empty one for null."""
    col = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(col, F.lit(_BLANKS))
    return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACE}+", -1))


def word_count(text: Column | str) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(col, F.lit(_BLANKS))
    return F.when(trimmed.isNull() | (trimmed == ""), F.lit(0)).otherwise(
        F.size(F.split(trimmed, f"{SPACE}+", -1))).cast("bigint")


def held_out(key: Column | str) -> Column:
    """True for the rows that no model may learn from; false where the key is null."""
    col = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD,
                      F.lit(False))


def fold(key: Column | str) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS, F.lit(0))


SLICE_BYTES = 512 << 10


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``SLICE_BYTES``, so that what is made of one is small."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one slice of a batch to one batch."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = function(batch)
            if made.num_rows:
                yield made
    return df.mapInArrow(run, schema)


def finite_rows(column: pa.Array, length: int, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors with ``length`` components, all finite and below ``largest``, and these.

    ``column`` holds lists of doubles; null ones, and those with a null entry, are left out.
    """
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == length)
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    values = values.astype(np.float64).reshape(len(at), length)
    fine = (np.abs(values) < largest).all(1)      # not true of NaN, which null entries become
    return at[fine], values[fine]


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
