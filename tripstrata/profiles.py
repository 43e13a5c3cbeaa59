"""Cleaning profiles: named rule sets that turn raw trips into silver trips.

The five profiles clean the same records by different rules and are kept apart
on purpose.  A profile is data; :mod:`tripstrata.operators.clean` interprets it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """One acceptance rule.  ``reason`` names the rows the rule turns away."""

    reason: str
    column: str
    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_open: bool = False

    def compares(self) -> bool:
        """False for a rule that only asks for a value to be present."""
        return self.low is not None or self.high is not None

    def accepts(self) -> Column:
        """True when the value passes; NULL values do not pass."""
        value = F.col(self.column)
        tests = []
        if self.low is not None:
            tests.append(value > self.low if self.low_open else value >= self.low)
        if self.high is not None:
            tests.append(value < self.high if self.high_open else value <= self.high)
        if not tests:
            return value.isNotNull()
        passed = tests[0]
        for test in tests[1:]:
            passed = passed & test
        return passed


def present(column: str) -> Gate:
    return Gate(f"missing_{column}", column)


def between(reason: str, column: str, low: float, high: float) -> Gate:
    return Gate(reason, column, low, high)


def above_upto(reason: str, column: str, low: float, high: float | None = None) -> Gate:
    return Gate(reason, column, low, high, low_open=True)


@dataclass(frozen=True)
class Profile:
    """Rule set plus the conventions of the silver table it feeds."""

    name: str
    gates: tuple[Gate, ...]
    #: number given to Sunday by ``day_of_week`` (7 means the week starts Monday = 1)
    sunday: int = 1
    #: explicit dropoff-after-pickup rule (others imply it through the duration)
    ordered_times: bool = False
    #: fastest accepted average speed in mph
    max_speed: float | None = None
    #: decimals kept in ``trip_duration_minutes``; None keeps the exact quotient
    duration_digits: int | None = None
    #: value of a ratio whose denominator is not positive
    empty_ratio: float | None = 0.0


# The thresholds of the five rule sets.
PROFILES: dict[str, Profile] = {
    profile.name: profile
    for profile in (
        Profile(
            name="dbt",
            gates=(
                present("pickup_datetime"),
                present("dropoff_datetime"),
                present("trip_distance"),
                present("fare_amount"),
                present("total_amount"),
                between("distance", "trip_distance", 0.1, 100.0),
                between("fare", "fare_amount", 1.0, 500.0),
                above_upto("total", "total_amount", 0.0),
                between("duration", "trip_duration_minutes", 1.0, 240.0),
            ),
            ordered_times=True,
            empty_ratio=None,
        ),
        Profile(
            name="strict",
            gates=(
                present("pickup_datetime"),
                present("dropoff_datetime"),
                above_upto("distance", "trip_distance", 0.0, 200.0),
                above_upto("fare", "fare_amount", 0.0, 500.0),
                above_upto("total", "total_amount", 0.0),
                Gate("tip", "tip_amount", low=0.0),
                above_upto("passengers", "passenger_count", 0, 9),
                above_upto("duration", "trip_duration_minutes", 0.0, 300.0),
            ),
            sunday=0,
            max_speed=120.0,
            duration_digits=2,
        ),
        Profile(
            name="demo",
            gates=(
                present("pickup_datetime"),
                present("dropoff_datetime"),
                above_upto("distance", "trip_distance", 0.0, 200.0),
                above_upto("fare", "fare_amount", 0.0, 500.0),
                above_upto("total", "total_amount", 0.0),
                above_upto("duration", "trip_duration_minutes", 0.0, 300.0),
            ),
            sunday=0,
            duration_digits=2,
        ),
        Profile(
            name="spark",
            gates=(
                above_upto("distance", "trip_distance", 0.0),
                above_upto("fare", "fare_amount", 0.0),
                above_upto("total", "total_amount", 0.0),
                present("pickup_datetime"),
                present("dropoff_datetime"),
                Gate("duration", "trip_duration_minutes", 0.0, 300.0, low_open=True, high_open=True),
            ),
        ),
        Profile(
            name="sim",
            gates=(
                present("pickup_datetime"),
                present("dropoff_datetime"),
                present("tip_amount"),
                above_upto("distance", "trip_distance", 0.0),
                above_upto("fare", "fare_amount", 0.0),
                above_upto("total", "total_amount", 0.0),
                above_upto("duration", "trip_duration_minutes", 0.0),
            ),
            sunday=7,
            duration_digits=2,
        ),
    )
}


def get_profile(profile: str | Profile) -> Profile:
    """Look a profile up by name; profile objects (e.g. with own thresholds) pass through."""
    if isinstance(profile, Profile):
        return profile
    try:
        return PROFILES[profile]
    except KeyError:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(PROFILES)}") from None
