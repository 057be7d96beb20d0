"""Numeric expressions: rates, bands, weights and display rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def per_capita(num, den, per: float) -> Column:
    """``num / den * per``; a zero or NULL denominator gives NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den)) * F.lit(per)


def weighted(terms) -> Column:
    """Sum of ``weight * value``; an inverted term counts ``100 - value``."""
    total = None
    for c, weight, inverted in terms:
        value = F.lit(100) - _col(c) if inverted else _col(c)
        part = F.lit(float(weight)) * value
        total = part if total is None else total + part
    return total


def band(c, bands) -> Column:
    """Label of the first band (highest first) whose lower edge the value reaches.

    ``bands`` holds ``(label, lower edge or None, edge belongs to the band)``.
    """
    value, out = _col(c), F
    default = None
    for label, low, closed in bands:
        if low is None:
            default = label
            continue
        out = out.when(value >= low if closed else value > low, F.lit(label))
    return out.otherwise(F.when(value.isNotNull(), F.lit(default)))


def fixed_text(c, digits: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.format_string(f"%.{digits}f", _col(c).cast("double"))


def percent_change(first, last, digits: int = 0) -> Column:
    return F.round(F.try_divide(_col(last).cast("double") - _col(first), _col(first)) * 100, digits)
