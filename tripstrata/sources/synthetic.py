"""Synthetic raw trips, generated by Spark tasks.

``seed`` makes a run repeatable for a given number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRIP_SCHEMA

# Weights and value lists of the generated trips.
HOUR_WEIGHTS = (2, 1, 1, 1, 1, 2, 4, 8, 10, 9, 7, 8, 9, 8, 7, 7, 9, 11, 10, 9, 8, 7, 6, 4)
RATE_CODE_WEIGHTS = {1: 80, 2: 5, 3: 3, 4: 2, 5: 5, 6: 5}
PAYMENT_WEIGHTS = {1: 65, 2: 30, 3: 3, 4: 2}
PASSENGER_WEIGHTS = {1: 65, 2: 15, 3: 8, 4: 5, 5: 4, 6: 3}
TIP_RATE_WEIGHTS = {0.0: 10, 0.15: 15, 0.18: 25, 0.20: 30, 0.25: 15, 0.30: 5}
EXTRA_WEIGHTS = {0.0: 30, 0.5: 50, 1.0: 20}
TOLL_WEIGHTS = {0.0: 85, 5.76: 6, 6.12: 5, 10.0: 4}
CONGESTION_WEIGHTS = {0.0: 20, 2.5: 70, 2.75: 10}
ZONES = 265
DAYS = 28
LOG_MINUTES_MEAN, LOG_MINUTES_SD = 3.0, 0.8
MINUTES_RANGE = (2.0, 180.0)
SPEED_RANGE = (5.0, 30.0)
MILES_RANGE = (0.1, 50.0)


class _Draws:
    """Independent random columns, one seed each."""

    def __init__(self, seed: int):
        self._seed = seed

    def _next(self) -> int:
        self._seed += 1
        return self._seed

    def uniform(self, low: float, high: float) -> Column:
        return F.lit(low) + F.rand(self._next()) * (high - low)

    def integer(self, low: int, high: int) -> Column:
        return F.floor(F.rand(self._next()) * (high - low + 1)).cast("int") + low

    def normal(self) -> Column:
        return F.randn(self._next())

    def roll(self) -> Column:
        return F.rand(self._next())


def _pick(roll: str, weighted: dict, kind: str) -> Column:
    """Value whose cumulative weight first exceeds the roll (a column in [0, 1))."""
    total, reached, steps = sum(weighted.values()), 0, []
    for value, weight in weighted.items():
        reached += weight
        steps.append(F.when(F.col(roll) < reached / total, F.lit(value).cast(kind)))
    return F.coalesce(*steps, F.lit(list(weighted)[-1]).cast(kind))


def _clip(value: Column, bounds: Sequence[float]) -> Column:
    return F.least(F.greatest(value, F.lit(bounds[0])), F.lit(bounds[1]))


def _cents(value: Column) -> Column:
    return F.round(value, 2)


def _month_start(year: int, month: int) -> Column:
    return F.make_timestamp_ntz(*[F.lit(part) for part in (year, month, 1, 0, 0, 0)])


def synthetic_trips(
    spark: SparkSession, rows: int = 10_000, year: int = 2024, month: int = 1, seed: int = 1, partitions: int | None = None
) -> DataFrame:
    """Realistic trips: rush hours, log-normal durations, fares by rate code, card tips.

    Rolls are drawn in a first projection and used in later ones, so every use
    of a roll sees the same value.
    """
    draw = _Draws(seed)
    rolled = spark.range(0, rows, 1, partitions).select(
        *[draw.roll().alias(f"_{name}") for name in ("hour", "rate", "paid", "tip_rate", "extra", "tolls", "zone_fee", "riders", "flag")],
        draw.integer(0, DAYS - 1).alias("_day"),
        draw.integer(0, 59).alias("_minute"),
        draw.integer(0, 59).alias("_second"),
        _clip(F.exp(draw.normal() * LOG_MINUTES_SD + LOG_MINUTES_MEAN), MINUTES_RANGE).alias("_minutes"),
        draw.uniform(*SPEED_RANGE).alias("_speed"),
        draw.uniform(-0.5, 2.0).alias("_metered_extra"),
        draw.uniform(52.0, 60.0).alias("_flat_fare"),
        draw.integer(1, 2).alias("vendor_id"),
        draw.integer(1, ZONES).alias("pu_location_id"),
        draw.integer(1, ZONES).alias("do_location_id"),
    )
    drawn = rolled.withColumns(
        {
            "_hour_of_day": _pick("_hour", dict(enumerate(HOUR_WEIGHTS)), "int"),
            "rate_code_id": _pick("_rate", RATE_CODE_WEIGHTS, "int"),
            "payment_type": _pick("_paid", PAYMENT_WEIGHTS, "int"),
            "passenger_count": _pick("_riders", PASSENGER_WEIGHTS, "int"),
            "extra": _pick("_extra", EXTRA_WEIGHTS, "double"),
            "tolls_amount": _pick("_tolls", TOLL_WEIGHTS, "double"),
            "congestion_surcharge": _pick("_zone_fee", CONGESTION_WEIGHTS, "double"),
            "store_and_fwd_flag": F.when(F.col("_flag") < 0.98, "N").otherwise("Y"),
            "mta_tax": F.lit(0.5),
            "improvement_surcharge": F.lit(0.3),
            "trip_distance": _cents(_clip(F.col("_minutes") / 60 * F.col("_speed"), MILES_RANGE)),
        }
    )
    start = _month_start(year, month) + F.make_dt_interval("_day", "_hour_of_day", "_minute", "_second")
    seconds = F.floor(F.col("_minutes") * 60).cast("decimal(18,6)")
    metered = F.col("trip_distance") * 2.5 + 3.5 + F.col("_metered_extra")
    fare = (
        F.when(F.col("rate_code_id") == 1, metered)
        .when(F.col("rate_code_id") == 2, F.col("_flat_fare"))
        .otherwise(F.col("trip_distance") * 2.0 + 3.5)
    )
    timed = drawn.withColumns({"pickup_datetime": start, "fare_amount": _cents(F.greatest(fare, F.lit(3.0)))})
    tip = F.when(F.col("payment_type") == 1, _cents(F.col("fare_amount") * _pick("_tip_rate", TIP_RATE_WEIGHTS, "double")))
    priced = timed.withColumns(
        {
            "dropoff_datetime": F.col("pickup_datetime")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds),
            "tip_amount": F.coalesce(tip, F.lit(0.0)),
        }
    )
    parts = "fare_amount tip_amount extra mta_tax improvement_surcharge tolls_amount congestion_surcharge".split()
    total = F.lit(0.0)
    for part in parts:
        total = total + F.col(part)
    return priced.withColumn("total_amount", _cents(total)).select(*TRIP_SCHEMA.names)


def uniform_trips(
    spark: SparkSession,
    rows: int = 2_000,
    year: int = 2024,
    month: int = 1,
    seed: int = 1,
    miles: tuple[float, float] = (0.5, 25.0),
    minutes: tuple[int, int] = (3, 90),
    fare_spread: float = 5.0,
    tip_share: float = 0.3,
    fees: float = 1.3,
    partitions: int | None = None,
) -> DataFrame:
    """Plain trips with uniform draws; the arguments cover the simpler generators."""
    draw = _Draws(seed)
    drawn = spark.range(0, rows, 1, partitions).select(
        draw.integer(0, DAYS - 1).alias("_day"),
        draw.integer(0, 86_399).alias("_second"),
        draw.integer(*minutes).alias("_minutes"),
        _cents(draw.uniform(*miles)).alias("trip_distance"),
        draw.uniform(0.0, fare_spread).alias("_spread"),
        draw.uniform(0.0, tip_share).alias("_share"),
        draw.integer(1, 2).alias("vendor_id"),
        draw.integer(1, 6).alias("passenger_count"),
        draw.integer(1, ZONES).alias("pu_location_id"),
        draw.integer(1, ZONES).alias("do_location_id"),
        draw.integer(1, 4).alias("payment_type"),
    )
    zero = F.lit(0)
    start = _month_start(year, month) + F.make_dt_interval("_day", zero, zero, F.col("_second").cast("decimal(18,6)"))
    priced = drawn.withColumns(
        {
            "pickup_datetime": start,
            "fare_amount": _cents(F.col("trip_distance") * 2.5 + 2.5 + F.col("_spread")),
        }
    ).withColumns(
        {
            "dropoff_datetime": F.col("pickup_datetime") + F.make_dt_interval(zero, zero, "_minutes"),
            "tip_amount": _cents(F.col("fare_amount") * F.col("_share")),
        }
    )
    constants = {
        "rate_code_id": F.lit(1),
        "store_and_fwd_flag": F.lit("N"),
        "extra": F.lit(0.5),
        "mta_tax": F.lit(0.5),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(0.3),
        "congestion_surcharge": F.lit(2.5),
        "total_amount": _cents(F.col("fare_amount") + F.col("tip_amount") + fees),
    }
    return priced.withColumns(constants).select(*TRIP_SCHEMA.names)
