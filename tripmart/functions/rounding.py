"""Rounding that stays exact however many rows were summed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schemas import HUNDREDTHS, REVENUE

WHOLE = T.DecimalType(20, 0)


def to_hundredths(total: Column) -> Column:
    """A decimal sum rounded to two places, half away from zero."""
    return F.round(total, 2).cast(REVENUE)


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to two places, half away from zero; NULL for a zero denominator.

    A decimal division keeps only some digits of the quotient and rounding those again can push a
    value over the half. Integer division needs no such step: with ``n`` scaled to hundredths,
    ``floor(n/d + 1/2) = (2n + d) div 2d``.
    """
    magnitude = F.call_function(
        "div", F.abs(numerator) * F.lit(200) + denominator, F.nullif(denominator * F.lit(2), F.lit(0))
    )
    signed = F.when(numerator < 0, -magnitude).otherwise(magnitude)
    return (signed.cast(WHOLE) * F.lit(Decimal("0.01"))).cast(HUNDREDTHS)
