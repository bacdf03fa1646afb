"""Coded values turned into readable ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes and their labels; any other code, or none, is Unknown.
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
OTHER_PAYMENT = "Unknown"


def payment_label(code: Column) -> Column:
    label = F.lit(OTHER_PAYMENT)
    for value, name in PAYMENT_LABELS.items():
        label = F.when(code == value, name).otherwise(label)
    return label


def whole_passengers(count: Column) -> Column:
    """A fractional count rounded half away from zero; not-a-number counts as missing."""
    return F.when(~F.isnan(count), F.round(count, 0).cast("int"))
