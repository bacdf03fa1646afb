"""Column functions: exact rounding, calendar parts and code labels."""

from tripmart.functions.calendar import day_name, is_weekend, minutes_between, time_period
from tripmart.functions.labels import payment_label, whole_passengers
from tripmart.functions.rounding import exact_ratio, to_hundredths

__all__ = [
    "day_name", "exact_ratio", "is_weekend", "minutes_between", "payment_label", "time_period",
    "to_hundredths", "whole_passengers",
]
