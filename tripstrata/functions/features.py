"""Trip features as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, as_column, guarded_ratio

# Hour ranges (inclusive), labels and codes.
TIME_OF_DAY_RANGES = (
    (6, 9, "morning_rush"),
    (10, 15, "midday"),
    (16, 19, "evening_rush"),
    (20, 22, "evening"),
)
TIME_OF_DAY_DEFAULT = "overnight"
TIME_OF_DAY_VALUES = ("morning_rush", "midday", "evening_rush", "evening", "overnight")
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
PAYMENT_LABELS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}
PAYMENT_DEFAULT = "unknown"
AIRPORT_ZONES = (132, 138)
LONG_TRIP_MILES = 10
DISTANCE_CLASSES = ((1, "short"), (5, "medium"), (15, "long"))
DISTANCE_DEFAULT = "very_long"
BUSINESS_HOURS = (8, 18)


def _pick(labels: Sequence[str | None], index: Column) -> Column:
    """Label at a position (from 0); NULL outside the list.  A constant array keeps the code small."""
    return F.get(F.array(*[F.lit(label) for label in labels]), index)


def duration_minutes(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole seconds between two timestamps, in minutes."""
    return (F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))) / 60.0


def day_of_week(date: ColumnLike, sunday: int = 1) -> Column:
    """Weekday number: Sunday is 1 (1..7), 0 (0..6) or 7 (Monday = 1)."""
    day = as_column(date)
    if sunday == 7:
        return F.weekday(day) + 1
    return F.dayofweek(day) - (1 - sunday)


def day_name(dow: ColumnLike, sunday: int = 1) -> Column:
    """English weekday name; NULL for a number outside the week."""
    return _pick(DAY_NAMES, as_column(dow) - sunday)


def is_weekend(dow: ColumnLike, sunday: int = 1) -> Column:
    return F.coalesce(as_column(dow).isin(sunday, sunday + 6), F.lit(False))


def time_of_day(hour: ColumnLike) -> Column:
    by_hour = [TIME_OF_DAY_DEFAULT] * 24
    for first, last, label in TIME_OF_DAY_RANGES:
        by_hour[first : last + 1] = [label] * (last + 1 - first)
    return F.coalesce(_pick(by_hour, as_column(hour)), F.lit(TIME_OF_DAY_DEFAULT))


def payment_label(code: ColumnLike) -> Column:
    by_code = [PAYMENT_LABELS.get(number) for number in range(max(PAYMENT_LABELS) + 1)]
    return F.coalesce(_pick(by_code, as_column(code)), F.lit(PAYMENT_DEFAULT))


def was_tipped(tip: ColumnLike) -> Column:
    return F.coalesce(as_column(tip) > 0, F.lit(False))


def speed_mph(distance: ColumnLike, minutes: ColumnLike, default: float | None = None) -> Column:
    return guarded_ratio(distance, as_column(minutes) / 60.0, default)


def is_long_trip(distance: ColumnLike) -> Column:
    return as_column(distance) >= LONG_TRIP_MILES


def is_airport_trip(pickup_zone: ColumnLike, dropoff_zone: ColumnLike) -> Column:
    return as_column(pickup_zone).isin(*AIRPORT_ZONES) | as_column(dropoff_zone).isin(*AIRPORT_ZONES)


def distance_class(distance: ColumnLike) -> Column:
    """Size class of a distance in miles; NULL counts as the largest class."""
    value = as_column(distance)
    return F.coalesce(
        *[F.when(value < limit, F.lit(label)) for limit, label in DISTANCE_CLASSES],
        F.lit(DISTANCE_DEFAULT),
    )


def business_hours(hour: ColumnLike) -> Column:
    return F.coalesce(as_column(hour).between(*BUSINESS_HOURS), F.lit(False))
