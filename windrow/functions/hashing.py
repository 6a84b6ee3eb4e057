"""Hash-based pseudo-random numbers that do not depend on the partition layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_fraction(*columns: str | Column, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the values of ``columns`` and ``seed`` alone.

    The first 32 bits of an md5 digest, so any engine with md5 can reproduce it.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    digest = F.md5(F.concat_ws("#", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
