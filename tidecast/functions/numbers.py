"""Arithmetic of the metric tables, with the NULL rules each formula needs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def null_safe_sum(*parts: Column) -> Column:
    """M1: sum of columns in which NULL counts as zero."""
    total = F.coalesce(parts[0], F.lit(0))
    for part in parts[1:]:
        total = total + F.coalesce(part, F.lit(0))
    return total


def discounted(value: Column, preferred: Column, fallback: Column) -> Column:
    """M2: value reduced by the preferred score, else the fallback score, else nothing."""
    return value * (F.lit(1) - F.coalesce(preferred, fallback, F.lit(0)))


def profit(commission: Column, cost: Column) -> Column:
    """M3: NULL when either side is NULL."""
    return commission - cost


def log_transform(y: Column) -> Column:
    """M6."""
    return F.ln(y)


def box_cox(y: Column, lam: float) -> Column:
    """M7: Box-Cox with a given lambda."""
    return F.ln(y) if lam == 0 else (F.pow(y, F.lit(float(lam))) - F.lit(1.0)) / F.lit(float(lam))


def inverse_log(value: Column) -> Column:
    """The y of a log transform."""
    return F.exp(value)


def inverse_box_cox(value: Column, lam: float) -> Column:
    """The y of a Box-Cox transform; 0 below the range that the transform can reach."""
    if lam == 0:
        return F.exp(value)
    inside = value * F.lit(float(lam)) + F.lit(1.0)
    return F.pow(F.greatest(inside, F.lit(0.0)), F.lit(1.0 / lam))


def round_half_even(value: Column, digits: int = 0) -> Column:
    """M8: banker's rounding, as forecasts are rounded."""
    return F.bround(value, digits)
