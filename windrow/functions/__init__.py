"""Column functions: everything here builds an expression and runs inside the JVM."""

from windrow.functions.clock import micros, window_index
from windrow.functions.hashing import hash_fraction
from windrow.functions.missing import nan_to, null_if_nan, nullify_nan, present
from windrow.functions.numeric import (
    chi2_tail, erfc, normal_quantile, poisson_pmf, ratio_or, ratio_or_zero,
)
from windrow.functions.text import bracket_number, digits_of

__all__ = [
    "bracket_number", "chi2_tail", "digits_of", "erfc", "hash_fraction", "micros", "nan_to",
    "normal_quantile", "null_if_nan", "nullify_nan", "poisson_pmf", "present", "ratio_or",
    "ratio_or_zero", "window_index",
]
