"""Column functions.  All are compositions of built-in expressions."""

from .features import (  # noqa: F401
    AIRPORT_ZONES,
    PAYMENT_LABELS,
    TIME_OF_DAY_VALUES,
    business_hours,
    day_name,
    day_of_week,
    distance_class,
    duration_minutes,
    is_airport_trip,
    is_long_trip,
    is_weekend,
    payment_label,
    speed_mph,
    time_of_day,
    was_tipped,
)
from .distinct import DistinctIds, first_of  # noqa: F401
from .numeric import clean_number, exact_avg, exact_sum, guarded_ratio, joined_sum, percent_of_rows, positive_ratio, round_half_up, safe_divide, sum_parts  # noqa: F401
