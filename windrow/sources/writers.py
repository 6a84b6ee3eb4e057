"""Writers. Partition sizes are left to adaptive execution: a rebalance puts the rows of a key
together and splits a key that is too large for one task."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.session import durable

ROWS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str],
                      rows_per_file: int = ROWS_PER_FILE) -> None:
    """Parquet partitioned by ``keys``, few files per key."""
    (df.hint("rebalance", *keys).write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path))


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """As :func:`write_partitioned`, with the rows of every file in ``order``.

    The sort starts with the partition columns: a sort without them is undone by the writer.
    """
    (df.hint("rebalance", *keys).sortWithinPartitions(*keys, *order)
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(*keys).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_results(df: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report-sized table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """A table of any size as CSV files with a header."""
    (df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file)
     .csv(path))


def export_reports(reports: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Write every report to ``folder/name`` and return the paths."""
    paths = []
    for name, df in reports.items():
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"not a report name: {name}")
        paths.append(f"{folder.rstrip('/')}/{name}")
        write_report(df, paths[-1])
    return paths


def table_facts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, columns and distinct values per key."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.lit(len(df.columns))).alias("n_columns"),
                  *[F.count_distinct(k).alias(f"distinct_{k}") for k in keys])


def verify_written(spark: SparkSession, path: str, expected: DataFrame,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Read back and compare with ``expected``: (fact, written, expected, passed)."""
    facts = ["n_rows", "n_columns", *[f"distinct_{k}" for k in keys]]
    # an aggregate over no rows leaves max() null
    back = table_facts(spark.read.parquet(path), keys).unpivot(
        [], [F.col(f).cast("bigint").alias(f) for f in facts], "fact", "written")
    want = table_facts(expected, keys).unpivot(
        [], [F.col(f).cast("bigint").alias(f) for f in facts], "fact", "expected")
    return back.join(F.broadcast(want), "fact").select(
        "fact", "written", "expected", F.col("written").eqNullSafe(F.col("expected"))
        .alias("passed"))


class WriteError(RuntimeError):
    """What was read back is not what was written."""


def _fingerprint(df: DataFrame) -> list[Column]:
    """Rows, columns, and a sum of row hashes that does not depend on the order of rows."""
    names = sorted(df.columns)
    # position and emptiness of a null have to count as well
    parts = [p for c in names for p in (F.col(f"`{c}`").cast("string"), F.col(f"`{c}`").isNull())]
    return [F.count(F.lit(1)).alias("n_rows"), F.max(F.lit(len(names))).alias("n_columns"),
            F.sum(F.xxhash64(*parts).cast("decimal(38,0)")).alias("checksum")]


def write_verified(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]
                   ) -> tuple[DataFrame, list[tuple]]:
    """Write by ``write(df, path)``, read back, and raise :class:`WriteError` where they differ.

    The rows are made durable first and both written and counted from there, so the input is
    computed once. (Counting them on their way, by an observation, would leave the session with an
    object that linear support vector models of that session then fail to serialise.) Returns the
    table as read, and (fact, written, expected, passed) per fact.
    """
    kept = durable(df)
    write(kept, path)
    expected = kept.agg(*_fingerprint(kept)).first().asDict()
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    written = back.agg(*_fingerprint(back)).first().asDict()
    facts = [(k, None if written[k] is None else int(written[k]),
              None if expected[k] is None else int(expected[k])) for k in written]
    wrong = [f for f in facts if f[1] != f[2]]
    if wrong:
        raise WriteError(f"{path}: " + "; ".join(f"{k} {w} instead of {e}" for k, w, e in wrong))
    return back, [(*f, True) for f in facts]
