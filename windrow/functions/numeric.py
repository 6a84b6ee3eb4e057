"""Distribution functions as column arithmetic, and guarded ratios."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 7.1.26, error function, absolute error below 1.5e-7.
ERF_P = 0.3275911
ERF_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

# Acklam's rational approximation of the normal quantile, relative error 1.15e-9.
QUANTILE_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
              1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
QUANTILE_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
              6.680131188771972e+01, -1.328068155288572e+01, 1.0)
QUANTILE_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
              -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
QUANTILE_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
              3.754408661907416e+00, 1.0)
QUANTILE_LOW = 0.02425

# Stirling's series for ln(k!), coefficients of k**-1, k**-3, ...
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
STIRLING_FROM = 16


def _horner(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def erfc(x: Column) -> Column:
    """Complementary error function for ``x >= 0``."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    return _horner(tuple(reversed(ERF_COEFFICIENTS)), t) * t * F.exp(-x * x)


def chi2_tail(statistic: Column) -> Column:
    """Upper tail of the chi-squared distribution with one degree of freedom."""
    return erfc(F.sqrt(statistic / F.lit(2.0)))


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function for 0 < p < 1."""
    middle = p - F.lit(0.5)
    square = middle * middle
    centre = _horner(QUANTILE_A, square) * middle / _horner(QUANTILE_B, square)

    def tail(side: Column) -> Column:
        q = F.sqrt(F.lit(-2.0) * F.ln(side))
        return _horner(QUANTILE_C, q) / _horner(QUANTILE_D, q)

    return (F.when(p < QUANTILE_LOW, tail(p))
            .when(p > 1 - QUANTILE_LOW, -tail(F.lit(1.0) - p))
            .otherwise(centre))


def _stirling_rest(k: Column) -> Column:
    """ln(k!) less Stirling's formula, for whole k > 0."""
    known = F.array(*[F.lit(math.lgamma(i + 1) - (i + 0.5) * math.log(i) + i
                            - 0.5 * math.log(2 * math.pi)) for i in range(1, STIRLING_FROM)])
    series = _horner(tuple(reversed(STIRLING)), 1 / (k * k)) / k
    return F.when(k < STIRLING_FROM, F.get(known, k.cast("int") - 1)).otherwise(series)


def poisson_pmf(k: Column, mean: Column) -> Column:
    """P(Poisson(mean) = k) to double precision, for any mean above 0 and whole k >= 0.

    The exponent is written as the deviance of k from the mean, so that no large numbers cancel.
    """
    k = k.cast("double")
    away = (mean - k) / k
    deviance = k * (away - F.log1p(away))
    usual = F.exp(-_stirling_rest(k) - deviance) / F.sqrt(F.lit(2 * math.pi) * k)
    return F.when(k == 0, F.exp(-mean)).otherwise(usual)


def ratio_or(numerator: Column, denominator: Column, default: float | None) -> Column:
    """``numerator / denominator``, or ``default`` when the denominator is zero."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if default is None:
        return value
    return F.when(denominator == 0, F.lit(default)).otherwise(value)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return ratio_or(numerator, denominator, 0.0)
