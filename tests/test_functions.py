from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart import functions as fn

CENT = Decimal("0.01")


def one(spark, column):
    return spark.range(1).select(column.alias("value")).first()["value"]


def ratios(spark, pairs):
    frame = spark.createDataFrame(pairs, "total decimal(38,6), n long")
    return [row[0] for row in frame.select(fn.exact_ratio(F.col("total"), F.col("n"))).collect()]


def test_ratio_rounds_halves_away_from_zero(spark):
    pairs = [(Decimal("80.99"), 2), (Decimal("-4.69"), 2), (Decimal("0.01"), 2), (Decimal(0), 3), (None, 1), (Decimal(1), 0)]
    assert ratios(spark, pairs) == [Decimal("40.50"), Decimal("-2.35"), CENT, Decimal("0.00"), None, None]


def test_ratio_just_below_a_half_of_a_huge_group_is_not_pushed_over_it(spark):
    rows = 700_000_000_001
    half = Decimal("12.345") * rows
    below, above = half - Decimal("0.000001"), half
    assert ratios(spark, [(below, rows), (above, rows)]) == [Decimal("12.34"), Decimal("12.35")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**14, 10**14), st.integers(1, 10**9)), min_size=1, max_size=50))
def test_ratio_matches_decimal_arithmetic(spark, pairs):
    pairs = [(Decimal(micros) / 10**6, n) for micros, n in pairs]
    expected = [(total / n).quantize(CENT, ROUND_HALF_UP) for total, n in pairs]
    assert ratios(spark, pairs) == expected


def test_sum_rounds_half_away_from_zero(spark):
    frame = spark.createDataFrame([(Decimal("2.345"),), (Decimal("-2.345"),)], "total decimal(38,6)")
    assert [row[0] for row in frame.select(fn.to_hundredths(F.col("total"))).collect()] == [
        Decimal("2.35"), Decimal("-2.35"),
    ]


def test_calendar_columns_over_two_weeks(spark):
    moments = [datetime(2026, 1, 1) + timedelta(hours=hours) for hours in range(24 * 14)]
    frame = spark.createDataFrame([(moment,) for moment in moments], "moment timestamp_ntz")
    moment = F.col("moment")
    rows = frame.select(moment, fn.day_name(moment), fn.is_weekend(moment), fn.time_period(moment)).collect()
    for at, name, weekend, period in rows:
        assert name == f"{at:%A}".ljust(9)
        assert weekend == (at.weekday() >= 5)
        hour = at.hour
        expected = (
            "Morning" if 5 <= hour <= 11 else "Afternoon" if 12 <= hour <= 16 else "Evening" if 17 <= hour <= 20 else "Night"
        )
        assert period == expected


def test_minutes_round_on_whole_microseconds(spark):
    start = datetime(2026, 1, 1)
    cases = {299_999: "0.00", 300_000: "0.01", 60_000_000: "1.00", 90_300_000: "1.51", -300_000: "-0.01", 0: "0.00"}
    for micros, expected in cases.items():
        end = start + timedelta(microseconds=micros)
        value = one(spark, fn.minutes_between(*[F.lit(str(at)).cast("timestamp_ntz") for at in (start, end)]))
        assert value == Decimal(expected)


def test_passengers_round_half_away_and_missing_stays_missing(spark):
    frame = spark.createDataFrame([(2.5,), (0.5,), (1.0,), (float("nan"),), (None,)], "n double")
    assert [row[0] for row in frame.select(fn.whole_passengers(F.col("n"))).collect()] == [3, 1, 1, None, None]


def test_payment_labels(spark):
    codes = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, None]
    frame = spark.createDataFrame([(code,) for code in codes], "code double")
    assert [row[0] for row in frame.select(fn.payment_label(F.col("code"))).collect()] == [
        "Unknown", "Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Unknown",
    ]
