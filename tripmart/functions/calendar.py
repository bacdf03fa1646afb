"""Calendar parts of a zone-less timestamp."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.schemas import MINUTES

# First and last hour of each named part of the day; every other hour is Night.
DAY_PARTS = {"Morning": (5, 11), "Afternoon": (12, 16), "Evening": (17, 20)}
OTHER_DAY_PART = "Night"

# Weekday names from Sunday, blank-padded to the width of the longest.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
DAY_NAME_WIDTH = 9

MICROS_PER_HUNDREDTH_MINUTE = 600_000


def day_name(moment: Column) -> Column:
    names = F.array(*[F.lit(name.ljust(DAY_NAME_WIDTH)) for name in DAY_NAMES])
    return F.element_at(names, F.dayofweek(moment))


def is_weekend(moment: Column) -> Column:
    return F.dayofweek(moment).isin(1, 7)  # Sunday is 1


def time_period(moment: Column) -> Column:
    hour = F.hour(moment)
    label = F.lit(OTHER_DAY_PART)
    for name, (first, last) in DAY_PARTS.items():
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes to two places, half away from zero, in whole-number arithmetic."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    half_up = F.abs(micros) + F.lit(MICROS_PER_HUNDREDTH_MINUTE // 2)
    hundredths = F.call_function("div", half_up, F.lit(MICROS_PER_HUNDREDTH_MINUTE)) * F.signum(micros).cast("long")
    return (hundredths.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(MINUTES)
