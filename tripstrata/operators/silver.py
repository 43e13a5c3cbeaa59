"""Typed view and the five silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..profiles import Profile, get_profile
from ..schemas import MERGE_KEYS, RAW_VIEW_COLUMNS, SILVER_COLUMNS
from .clean import clean, with_time_columns
from .upsert import dedupe_updates

_VIEW_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "pickup_date": "date",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "trip_duration_minutes": "double",
}
_VIEW_NAMES = {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
VIEW_TO_TRIP_NAMES = {view: trip for trip, view in _VIEW_NAMES.items()}


def raw_trips(trips: DataFrame) -> DataFrame:
    """Typed 15-column view over trips; values that do not fit their type become NULL."""
    timed = trips if "trip_duration_minutes" in trips.columns else with_time_columns(trips)
    named = timed.withColumnsRenamed(_VIEW_NAMES)
    return named.select(
        *[F.col(name).try_cast(_VIEW_TYPES.get(name, "int")).alias(name) for name in RAW_VIEW_COLUMNS]
    )


def newest_first(silver: DataFrame) -> list[Column]:
    """Order that decides between trips with one merge key: the last to end first, then all other columns."""
    end = "tpep_dropoff_datetime"
    others = [name for name in silver.columns if name not in (*MERGE_KEYS, end)]
    return [F.desc(name) for name in (end, *others)]


def newest_per_key(silver: DataFrame) -> DataFrame:
    """One row per merge key; trips whose key is incomplete all stay."""
    return dedupe_updates(silver, MERGE_KEYS, newest_first(silver))


def register_raw_view(trips: DataFrame, name: str = "raw_trips") -> DataFrame:
    """Register :func:`raw_trips` as a temporary view for SQL users."""
    view = raw_trips(trips)
    view.createOrReplaceTempView(name)
    return view


def with_features(accepted: DataFrame, profile: str | Profile) -> DataFrame:
    """Add the feature columns of a profile to its accepted trips (exact duration still in place)."""
    rules = get_profile(profile)
    minutes, empty = F.col("trip_duration_minutes"), rules.empty_ratio
    features = {
        "avg_speed_mph": X.speed_mph("trip_distance", minutes, empty),
        "time_of_day": X.time_of_day("pickup_hour"),
        "was_tipped": X.was_tipped("tip_amount"),
        "tip_pct": X.guarded_ratio("tip_amount", "fare_amount", 0.0, scale=100.0),
        "fare_per_mile": X.guarded_ratio("fare_amount", "trip_distance", empty),
        "revenue_per_minute": X.guarded_ratio("total_amount", minutes, empty),
        "payment_type_label": X.payment_label("payment_type"),
    }
    if rules.name != "dbt":  # the typed view carries its own weekday number
        accepted = accepted.withColumn("day_of_week", X.day_of_week("pickup_date", rules.sunday))
    if rules.sunday != 7:
        features["day_name"] = X.day_name("day_of_week", rules.sunday)
        features["is_weekend"] = X.is_weekend("day_of_week", rules.sunday)
    if rules.name == "strict":
        features |= {
            "pickup_year": F.year("pickup_date"),
            "pickup_month": F.month("pickup_date"),
            "pickup_day": F.dayofmonth("pickup_date"),
            "is_long_trip": X.is_long_trip("trip_distance"),
            "is_airport_trip": X.is_airport_trip("pu_location_id", "do_location_id"),
        }
    featured = accepted.withColumns(features)
    if rules.duration_digits is not None:
        featured = featured.withColumn("trip_duration_minutes", X.round_half_up(minutes, rules.duration_digits))
    return featured


def _fill_defaults(trips: DataFrame, profile: Profile) -> DataFrame:
    """Defaults for absent cells that no rule of the profile tests."""
    if profile.name not in ("strict", "demo"):
        return trips
    gated = {gate.column for gate in profile.gates}
    zeros = {
        name: 0
        for name, kind in trips.dtypes
        if kind in ("int", "double") and name not in gated and name not in ("pickup_hour", "day_of_week")
    }
    return trips.fillna(zeros).fillna({"store_and_fwd_flag": "N"})


def build_silver(trips: DataFrame, profile: str | Profile) -> DataFrame:
    """Raw trips (or, for ``dbt``, the typed view) -> the profile's silver table."""
    rules = get_profile(profile)
    if "tpep_pickup_datetime" in trips.columns:
        trips = trips.withColumnsRenamed(VIEW_TO_TRIP_NAMES)
    accepted = _fill_defaults(clean(trips, rules), rules)
    if rules.name == "spark":
        featured = accepted
    else:
        featured = with_features(accepted, rules)
    if rules.name == "dbt":
        featured = featured.withColumnsRenamed(_VIEW_NAMES)
    return featured.select(*SILVER_COLUMNS[rules.name])
