"""Raw trips -> accepted and rejected trips, by profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import duration_minutes, round_half_up
from ..profiles import Profile, get_profile

REJECT_REASON = "reject_reason"
DROPOFF_ORDER = "dropoff_order"


def with_time_columns(trips: DataFrame) -> DataFrame:
    """Add exact duration in minutes, pickup date, hour and weekday (Sunday = 1)."""
    return trips.withColumns(
        {
            "trip_duration_minutes": duration_minutes("pickup_datetime", "dropoff_datetime"),
            "pickup_date": F.to_date("pickup_datetime"),
            "pickup_hour": F.hour("pickup_datetime"),
            "day_of_week": F.dayofweek("pickup_datetime"),
        }
    )


def _timed(trips: DataFrame) -> DataFrame:
    return trips if "trip_duration_minutes" in trips.columns else with_time_columns(trips)


def acceptance_rules(profile: str | Profile) -> list[tuple[str, Column]]:
    """(reason, accepts) pairs in the order the rules apply."""
    rules = get_profile(profile)
    pairs = [(gate.reason, gate.accepts()) for gate in rules.gates]
    if rules.ordered_times:
        pairs.append((DROPOFF_ORDER, F.col("dropoff_datetime") > F.col("pickup_datetime")))
    if rules.max_speed is not None:
        hours = F.col("trip_duration_minutes") / 60.0
        pairs.append(("speed", F.try_divide("trip_distance", hours) <= rules.max_speed))
    return pairs


def clean(trips: DataFrame, profile: str | Profile) -> DataFrame:
    """Trips that pass every rule of the profile.

    The rules form one conjunction, so those on stored columns reach the
    Parquet scan as pushed filters.  Rules implied by others are left out,
    because each rule repeats the expressions its columns are derived from:
    a comparison with NULL already turns a row away, and where the duration is
    computed here, a gate on it covers the presence of both times and, with a
    positive lower bound, their order.
    """
    rules = get_profile(profile)
    compared = {gate.column for gate in rules.gates if gate.compares()}
    own_duration = "trip_duration_minutes" not in trips.columns
    on_duration = [gate for gate in rules.gates if own_duration and gate.column == "trip_duration_minutes" and gate.compares()]
    in_order = any(g.low is not None and (g.low > 0 or (g.low == 0 and g.low_open)) for g in on_duration)
    if on_duration or rules.ordered_times:
        compared |= {"pickup_datetime", "dropoff_datetime"}
    implied = {gate.reason for gate in rules.gates if not gate.compares() and gate.column in compared}
    if in_order:
        implied.add(DROPOFF_ORDER)
    needed = [accepts for reason, accepts in acceptance_rules(rules) if reason not in implied]
    return _timed(trips).filter(reduce(lambda a, b: a & b, needed, F.lit(True)))


def reject_reason(profile: str | Profile) -> Column:
    """First rule a timed trip fails; NULL when it passes all."""
    return F.coalesce(
        *[
            F.when(~F.coalesce(accepts, F.lit(False)), F.lit(reason))
            for reason, accepts in acceptance_rules(profile)
        ]
    )


def with_reject_reason(trips: DataFrame, profile: str | Profile) -> DataFrame:
    """Add :func:`reject_reason` as a column."""
    return _timed(trips).withColumn(REJECT_REASON, reject_reason(profile))


def split_rejects(trips: DataFrame, profile: str | Profile) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); the rejected side keeps its ``reject_reason``."""
    tagged = with_reject_reason(trips, profile)
    accepted = tagged.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)
    return accepted, tagged.filter(F.col(REJECT_REASON).isNotNull())


def reject_summary(trips: DataFrame, *profiles: str) -> DataFrame:
    """Rows and share of all rows per profile and first failing rule (``accepted`` included).

    One pass over the trips for any number of profiles.  The shares are
    computed on the counts: per profile one short list, an entry per rule.
    """
    verdicts = F.array(
        *[
            F.struct(
                F.lit(profile).alias("profile"),
                F.coalesce(reject_reason(profile), F.lit("accepted")).alias(REJECT_REASON),
            )
            for profile in profiles
        ]
    )
    counts = (
        _timed(trips).select(F.inline(verdicts)).groupBy("profile", REJECT_REASON).agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        counts.groupBy("profile")
        .agg(F.sum("rows").alias("total"), F.collect_list(F.struct(REJECT_REASON, "rows")).alias("parts"))
        .select("profile", "total", F.inline("parts"))
        .select(
            "profile", REJECT_REASON, "rows", round_half_up(F.col("rows") * 100.0 / F.col("total"), 1).alias("rate_pct")
        )
    )
