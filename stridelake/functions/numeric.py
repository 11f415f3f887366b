"""Guarded arithmetic, the inverse normal distribution and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of Acklam's published approximation of the inverse normal distribution.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
_LOW = 0.02425


def rate(num: Column, den: Column) -> Column:
    """num / den as a double; 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def inv_norm(p: Column) -> Column:
    """Inverse of the normal distribution; null outside (0, 1)."""
    tail = lambda q: F.try_divide(_poly(_C, q), _poly(_D, q))
    middle = p - 0.5
    square = middle * middle
    return (
        F.when((p <= 0) | (p >= 1), None)
        .when(p < _LOW, tail(F.sqrt(-2 * F.log(F.when((p > 0) & (p < 1), p)))))
        .when(p > 1 - _LOW, -tail(F.sqrt(-2 * F.log(F.when((p > 0) & (p < 1), 1 - p)))))
        .otherwise(middle * F.try_divide(_poly(_A, square), _poly(_B, square)))
    )


def clamp_to(col: Column, low: float | Column | None, high: float | Column | None) -> Column:
    """A value kept within bounds; null stays null."""
    out = col
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(col.isNotNull(), out)


def relevance(finish: Column, scheme: str, alpha: float = 0.8) -> Column:
    """Training label of a finish: ``decay`` alpha^(fin-1), ``points``, ``top4`` flag or ``class8``."""
    if scheme == "decay":
        return F.pow(F.lit(alpha), finish - 1)
    if scheme == "points":
        fixed = F.when(finish == 1, 70.0).when(finish == 2, 56.0).when(finish == 3, 44.0).when(finish == 4, 34.0)
        return fixed.when(finish > 4, F.lit(30.0) / F.log(finish + 4))
    if scheme == "top4":
        return F.when(finish.isNotNull(), (finish <= 4).cast("int"))
    if scheme == "class8":
        return F.when(finish.isNotNull(), F.least(finish, F.lit(8)).cast("int") - 1)
    raise ValueError(f"unknown scheme {scheme}")
