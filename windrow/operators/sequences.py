"""Complete windows as fixed-length sequences, one row per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import micros
from windrow.operators.ordering import dense_index
from windrow.operators.windows import WindowSpec, assign_windows, keep_complete

STEPS_FIRST, CHANNELS_FIRST = "steps", "channels"


def complete_rows(df: DataFrame, spec: WindowSpec, channels: Sequence[str], length: int,
                  extra: Sequence[str] = ()) -> DataFrame:
    """Keys, window, time and channels of the rows in complete windows."""
    windowed = assign_windows(df, spec)
    kept = keep_complete(windowed, spec, length)
    names = dict.fromkeys([*spec.keys, spec.time, *extra, *channels])
    return kept.select(*names)


def assemble(rows: DataFrame, spec: WindowSpec, channels: Sequence[str], length: int,
             tiebreak: str, layout: str = STEPS_FIRST, pad: float = 0.0,
             name: str = "sequence") -> DataFrame:
    """One row per window with its readings in time order, as floats.

    ``rows`` come from :func:`complete_rows`, so a window has exactly ``length`` of them and the
    collected array is bounded. ``layout`` gives an array per step (length x channels) or per
    channel (channels x length). Missing readings become ``pad``.
    """
    reading = F.array(*[F.coalesce(F.col(c), F.lit(pad)).cast("float") for c in channels])
    step = F.struct(micros(rows, spec.time).alias("t"), F.col(tiebreak).alias("b"),
                    reading.alias("v"))
    ordered = F.sort_array(F.collect_list(step))
    collected = rows.groupBy(*spec.keys).agg(ordered.alias("_steps"))

    def channel(i: int) -> Column:
        return F.transform("_steps", lambda s: s["v"][i])

    if layout == CHANNELS_FIRST:
        made = F.array(*[channel(i) for i in range(len(channels))])
    elif layout == STEPS_FIRST:
        made = F.transform("_steps", lambda s: s["v"])
    else:
        raise ValueError(f"unknown layout {layout}")
    return collected.select(*spec.keys, made.alias(name))


def number_windows(sequences: DataFrame, spec: WindowSpec, name: str = "sequence_id") -> DataFrame:
    """Metadata: every window's keys with its number in key order."""
    return dense_index(sequences.select(*spec.keys), spec.keys, name)
