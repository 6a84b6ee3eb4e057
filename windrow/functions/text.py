"""Keys hidden in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits_of(text: Column, pattern: str, group: int = 1) -> Column:
    """Integer captured by ``pattern``; null when there is no match or no number."""
    return F.regexp_extract(text, pattern, group).try_cast("int")


def bracket_number(text: Column) -> Column:
    """``4`` out of ``local[4]``."""
    return digits_of(text, r"\[(\d+)\]")
