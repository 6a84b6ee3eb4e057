"""Integer time: window arithmetic on doubles puts rows into the wrong window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000


def micros(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as whole microseconds.

    Accepts timestamps with or without zone, seconds as a floating or decimal number, and
    integers, which are taken to be microseconds already.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        instant = col.cast("timestamp")
        if df.sparkSession.conf.get("spark.sql.session.timeZone") != "UTC":
            # undo the session zone: the wall clock is what the column holds
            instant = F.from_utc_timestamp(instant, F.current_timezone())
        return F.unix_micros(instant)
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.round(col * F.lit(MICROS)).try_cast("bigint")  # NaN has no time: null
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return col.cast("bigint")
    raise TypeError(f"{name}: cannot read {kind.simpleString()} as a time")


def whole_micros(seconds: float) -> int:
    length = round(seconds * MICROS)
    if length <= 0:
        raise ValueError("a window needs a positive length")
    return length


def window_index(time_us: Column, origin_us: Column, length_us: int) -> Column:
    """Number of whole windows between the origin and the row, in integer arithmetic."""
    return F.call_function("div", time_us - origin_us, F.lit(length_us).cast("bigint"))
