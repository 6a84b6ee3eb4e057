"""Typed readers. Schemas are declared, files are found by pattern, nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.text import digits_of

# The layout of the raw sample files, in file order.
PLACES = ("hand", "chest", "ankle")
READINGS = ("temperature", "acc_16g_x", "acc_16g_y", "acc_16g_z", "acc_6g_x", "acc_6g_y",
            "acc_6g_z", "gyro_x", "gyro_y", "gyro_z", "mag_x", "mag_y", "mag_z",
            "orient_0", "orient_1", "orient_2", "orient_3")
TRIAXIAL_SENSORS = ("acc_16g", "acc_6g", "gyro", "mag")
METADATA = ("timestamp", "activity_id", "subject_id", "session_type")


def sample_schema(places: Sequence[str] = PLACES, readings: Sequence[str] = READINGS
                  ) -> T.StructType:
    """Time, label, heart rate, then every reading of every place."""
    schema = (T.StructType().add("timestamp", T.DoubleType(), False)
              .add("activity_id", T.IntegerType(), False)
              .add("heart_rate", T.DoubleType()))
    for place in places:
        for reading in readings:
            schema.add(f"{place}_{reading}", T.DoubleType())
    return schema


def file_key(pattern: str, source: Column | None = None) -> Column:
    """Integer captured from the name of the file a row came from."""
    name = F.col("_metadata.file_name") if source is None else source
    return digits_of(name, pattern)


def read_samples(spark: SparkSession, folder: str, session: str | None = None,
                 schema: T.StructType | None = None, files: str = "*.dat",
                 delimiter: str = " ", missing: str = "NaN",
                 key: str = "subject_id", key_pattern: str = r"subject(\d+)",
                 session_column: str = "session_type", nan_policy: str = "null") -> DataFrame:
    """Delimited sample files of one session with the key taken from the file name.

    The ``missing`` token becomes null; with ``nan_policy="keep"`` it stays a NaN.
    """
    if nan_policy not in ("null", "keep"):
        raise ValueError(f"unknown nan_policy {nan_policy}")
    option = "nullValue" if nan_policy == "null" else "nanValue"
    raw = (spark.read.schema(schema or sample_schema())
           .option("delimiter", delimiter).option("header", False).option(option, missing)
           .option("pathGlobFilter", files).csv(folder))
    columns = [*raw.columns, file_key(key_pattern).alias(key)]
    if session is not None:
        columns.append(F.lit(session).alias(session_column))
    return raw.select(*columns)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines in a single ``value`` column."""
    return spark.read.text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON list of records, as one multi-line document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV report with a header."""
    return spark.read.schema(schema).option("header", True).csv(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small dimension table written down in code."""
    return spark.createDataFrame(list(rows), schema)
