"""How a table is read as a set of time series: keys, order, measures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SeriesKey:
    """Rows with equal ``keys`` form one series, ordered by ``time`` and then ``tiebreak``.

    ``tiebreak`` has to be unique per series and instant: with equal timestamps and no
    tiebreak the result of an ordered window would depend on the shuffle.
    """

    keys: tuple[str, ...]
    time: str
    tiebreak: str

    def __init__(self, keys: str | Iterable[str], time: str, tiebreak: str):
        object.__setattr__(self, "keys", (keys,) if isinstance(keys, str) else tuple(keys))
        object.__setattr__(self, "time", time)
        object.__setattr__(self, "tiebreak", tiebreak)

    def order(self) -> list[Column]:
        return [F.col(self.time).asc(), F.col(self.tiebreak).asc()]


def measure_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Every double column that is not metadata, sorted by name."""
    skip = set(exclude)
    return sorted(
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType) and f.name not in skip
    )


def triaxial_groups(places: Sequence[str], sensors: Sequence[str],
                    axes: Sequence[str] = ("x", "y", "z")) -> dict[str, tuple[str, ...]]:
    """``{place}_{sensor}`` mapped to its axis columns, for every place and sensor."""
    return {
        f"{place}_{sensor}": tuple(f"{place}_{sensor}_{axis}" for axis in axes)
        for place in places for sensor in sensors
    }
