"""Every operator bound to the given tables, with the SQL that has to give the same rows."""

from bindings.registry import ORACLES, QUERIES
from bindings import (  # noqa: F401  (importing a module registers its queries)
    cleaning, filling, metrics, models, properties, quality, reports, splits, windows,
)

__all__ = ["ORACLES", "QUERIES"]
