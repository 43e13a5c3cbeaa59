"""Gold tables: KPIs by hour and by zone.

Every table is one grouped aggregation over silver.  Spark aggregates each
task's rows before the shuffle, so what moves is one row per group and task,
also when one hour or zone holds most of the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from .ranking import rank_hours, rank_zones

#: What is known of summed silver columns: bounded by the rules, rounded when they were computed.
SUMMED = {
    "fare_amount": {"bounded": True},
    "trip_distance": {"bounded": True},
    "trip_duration_minutes": {"bounded": True},
    "avg_speed_mph": {"bounded": True, "rounded": True},
    "fare_per_mile": {"bounded": True, "rounded": True},
    "revenue_per_minute": {"rounded": True},
    "tip_pct": {"rounded": True},
}


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum(name: str) -> Column:
    return X.exact_sum(name, finite=True, **SUMMED.get(name, {}))


def _avg(name: str) -> Column:
    # a sum is usually wanted too, and Spark shares it; avg() would keep its own
    return X.exact_avg(name, finite=True, **SUMMED.get(name, {}))


def _sum2(name: str) -> Column:
    return X.round_half_up(_sum(name), 2)


def _avg2(name: str) -> Column:
    return X.round_half_up(_avg(name), 2)


def _weekday_columns(sunday: int) -> dict[str, Column]:
    """Calendar attributes recomputed from the group's date, so they need not travel as keys."""
    dow = X.day_of_week("pickup_date", sunday)
    return {
        "day_of_week": dow,
        "day_name": X.day_name(dow, sunday),
        "is_weekend": X.is_weekend(dow, sunday),
        "time_of_day": X.time_of_day("pickup_hour"),
    }


# ---- hourly and zone KPIs of the ``dbt`` silver table ---------------------------------

#: Grouping columns; weekday name, weekend flag and day part are functions of them.
DAILY_KEYS = ("pickup_date", "pickup_hour", "day_of_week")

#: Summed columns of the hourly table, and what is known of them.
DAILY_SUMS = {
    name: {"finite": True, **SUMMED.get(name, {})}
    for name in (
        "total_amount", "fare_amount", "tip_amount", "tip_pct", "trip_distance", "trip_duration_minutes",
        "avg_speed_mph", "fare_per_mile", "revenue_per_minute",
    )
}


def gold_daily_hourly(silver: DataFrame) -> DataFrame:
    """Hourly KPIs: five keys, twenty measures, from one reading of silver.

    The distinct zones of an hour are counted by bitmaps (:class:`X.DistinctIds`), which add up like sums do.  Ids
    outside the bitmaps' range are grouping keys of the first aggregation, so an hour has one row there unless it
    holds such ids; each of them is marked where it first occurs, and the second aggregation counts the marks.
    """
    keys, tipped = list(DAILY_KEYS), F.col("was_tipped")
    zones = {"pickup": X.DistinctIds("pu_location_id"), "dropoff": X.DistinctIds("do_location_id")}
    odd = [f"odd_{name}" for name in zones]
    parts = {f"{column}__{part}": value for column, known in DAILY_SUMS.items() for part, value in X.sum_parts(column, **known).items()}
    counts = {
        "trip_count": _rows(),
        "tipped_trips": F.count_if(tipped),
        "credit_card_trips": F.count_if(F.col("payment_type") == 1),
        "cash_trips": F.count_if(F.col("payment_type") == 2),
        **{f"{column}__n": F.count(column) for column in DAILY_SUMS},
    }
    first = {
        **{name: F.sum(value) for name, value in parts.items()},
        "total_passengers": F.sum("passenger_count"),
        **counts,
    }
    words = {f"{name}__{k}": word for name, ids in zones.items() for k, word in enumerate(ids.words())}
    by_odd = silver.groupBy(*keys, *[ids.outside().alias(f"odd_{name}") for name, ids in zones.items()]).agg(
        *[value.alias(name) for name, value in first.items()], *[F.bit_or(word).alias(name) for name, word in words.items()]
    )
    marked = by_odd.withColumns({f"new_{name}": X.first_of(f"odd_{name}", keys, odd) for name in zones})
    hours = marked.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in first],
        *[F.bit_or(name).alias(name) for name in words],
        *[F.count_if(f"new_{name}").alias(f"new_{name}") for name in zones],
    )

    def total(column: str) -> Column:
        return X.joined_sum({part: F.col(f"{column}__{part}") for part in X.sum_parts(column, **DAILY_SUMS[column])})

    def sum2(column: str) -> Column:
        return X.round_half_up(total(column), 2)

    def avg2(column: str) -> Column:
        return X.round_half_up(total(column) / F.nullif(F.col(f"{column}__n"), F.lit(0)), 2)

    def share(name: str) -> Column:
        return X.round_half_up(F.col(name) * 100.0 / F.col("trip_count"), 2)

    def distinct(name: str) -> Column:
        return zones[name].count([F.col(f"{name}__{k}") for k in range(zones[name].size)]) + F.col(f"new_{name}")

    return hours.select(
        "pickup_date",
        "pickup_hour",
        "trip_count",
        "total_passengers",
        sum2("total_amount").alias("total_revenue"),
        avg2("total_amount").alias("avg_fare"),
        sum2("fare_amount").alias("total_fare_amount"),
        sum2("tip_amount").alias("total_tips"),
        avg2("tip_pct").alias("avg_tip_pct"),
        sum2("trip_distance").alias("total_miles"),
        avg2("trip_distance").alias("avg_distance"),
        avg2("trip_duration_minutes").alias("avg_duration_minutes"),
        avg2("avg_speed_mph").alias("avg_speed_mph"),
        avg2("fare_per_mile").alias("avg_fare_per_mile"),
        avg2("revenue_per_minute").alias("avg_revenue_per_minute"),
        "tipped_trips",
        share("tipped_trips").alias("tip_rate_pct"),
        "credit_card_trips",
        "cash_trips",
        share("credit_card_trips").alias("credit_card_pct"),
        distinct("pickup").alias("unique_pickup_zones"),
        distinct("dropoff").alias("unique_dropoff_zones"),
        X.day_name("day_of_week").alias("day_name"),
        X.is_weekend("day_of_week").alias("is_weekend"),
        X.time_of_day("pickup_hour").alias("time_of_day"),
    )


#: The columns of the hourly table, in order.
DAILY_SUMMARY_COLUMNS = (
    "pickup_date", "pickup_hour", "day_name", "is_weekend", "time_of_day", "trip_count", "total_passengers",
    "total_revenue", "avg_fare", "total_fare_amount", "total_tips", "avg_tip_pct", "total_miles", "avg_distance",
    "avg_duration_minutes", "avg_speed_mph", "avg_fare_per_mile", "avg_revenue_per_minute", "tipped_trips",
    "tip_rate_pct", "credit_card_trips", "cash_trips", "credit_card_pct", "unique_pickup_zones",
    "unique_dropoff_zones", "hour_rank_by_volume", "hour_rank_by_revenue", "rolling_7d_avg_trips",
    "is_peak_hour", "revenue_per_trip", "avg_passengers_per_trip",
)


def gold_daily_summary(silver: DataFrame) -> DataFrame:
    """Hourly KPIs with day ranks, rolling average and per-trip ratios (31 columns)."""
    per_trip = {
        "revenue_per_trip": X.guarded_ratio("total_revenue", "trip_count"),
        "avg_passengers_per_trip": X.guarded_ratio("total_passengers", "trip_count"),
    }
    return rank_hours(gold_daily_hourly(silver)).withColumns(per_trip).select(*DAILY_SUMMARY_COLUMNS)


#: Summed columns of the zone table.
ZONE_SUMS = {name: DAILY_SUMS[name] for name in ("total_amount", "trip_distance", "trip_duration_minutes", "tip_pct")}


def zone_days(silver: DataFrame) -> DataFrame:
    """Counts and exact sums per day and pickup zone, which add up to :func:`zone_stats` of any set of days."""
    return silver.groupBy("pickup_date", F.col("pu_location_id").alias("location_id")).agg(
        _rows().alias("trip_count"),
        F.count_if(F.col("was_tipped")).alias("tipped_trips"),
        *[F.sum(value).alias(f"{column}__{part}") for column, known in ZONE_SUMS.items() for part, value in X.sum_parts(column, **known).items()],
        *[F.count(column).alias(f"{column}__n") for column in ZONE_SUMS],
    )


def zone_stats(silver: DataFrame) -> DataFrame:
    """KPIs per pickup zone."""
    return stats_of_days(zone_days(silver))


def stats_of_days(days: DataFrame) -> DataFrame:
    """KPIs per pickup zone from :func:`zone_days`."""
    trips = F.sum("trip_count")

    def total(column: str) -> Column:
        return X.joined_sum({part: F.sum(f"{column}__{part}") for part in X.sum_parts(column, **ZONE_SUMS[column])})

    def avg2(column: str) -> Column:
        return X.round_half_up(total(column) / F.nullif(F.sum(f"{column}__n"), F.lit(0)), 2)

    return days.groupBy("location_id").agg(
        trips.alias("trip_count"),
        X.round_half_up(total("total_amount"), 2).alias("total_revenue"),
        avg2("total_amount").alias("avg_fare"),
        avg2("trip_distance").alias("avg_distance"),
        avg2("trip_duration_minutes").alias("avg_duration_minutes"),
        avg2("tip_pct").alias("avg_tip_pct"),
        X.round_half_up(F.sum("tipped_trips") * 100.0 / trips, 2).alias("tip_rate_pct"),
        _rows().alias("active_days"),
        X.guarded_ratio(trips, _rows(), digits=1).alias("avg_daily_trips"),
    )


def gold_location_performance(silver: DataFrame) -> DataFrame:
    """Zone KPIs with global ranks, revenue percentile and tier (15 columns)."""
    return rank_zones(zone_stats(silver))


# ---- gold tables of the other profiles -----------------------------------------------


def gold_spark(silver: DataFrame) -> DataFrame:
    """Hourly KPIs of the ``spark`` silver table, unrounded."""
    hourly = silver.groupBy("pickup_date", "pickup_hour", "day_of_week").agg(
        _rows().alias("trip_count"),
        _sum("total_amount").alias("total_revenue"),
        _avg("total_amount").alias("avg_fare"),
        _avg("trip_distance").alias("avg_distance"),
        _avg("trip_duration_minutes").alias("avg_duration_minutes"),
        F.sum("passenger_count").alias("total_passengers"),
        _avg("tip_amount").alias("avg_tip"),
        F.count_distinct("pu_location_id").alias("unique_pickup_zones"),
    )
    miles = F.col("trip_count") * F.col("avg_distance")
    return hourly.withColumns(
        {
            "revenue_per_mile": X.positive_ratio("total_revenue", miles, 0.0),
            "tip_percentage": X.positive_ratio("avg_tip", "avg_fare", 0.0) * 100,
        }
    )


def gold_hour_zone(silver: DataFrame) -> DataFrame:
    """Date x hour x pickup zone KPIs of the ``strict`` silver table (20 columns)."""
    keys = ["pickup_date", "pickup_hour", "pu_location_id"]
    measures = silver.groupBy(*keys).agg(
        _rows().alias("trip_count"),
        _sum2("total_amount").alias("total_revenue"),
        _avg2("total_amount").alias("avg_fare"),
        _avg2("trip_distance").alias("avg_distance_miles"),
        _avg2("trip_duration_minutes").alias("avg_duration_minutes"),
        _avg2("tip_amount").alias("avg_tip"),
        X.percent_of_rows(F.col("was_tipped"), 1).alias("tip_rate_pct"),
        X.percent_of_rows(F.col("is_long_trip"), 1).alias("long_trip_pct"),
        X.percent_of_rows(F.col("is_airport_trip"), 1).alias("airport_trip_pct"),
        F.sum("passenger_count").alias("total_passengers"),
        X.guarded_ratio(_sum("total_amount"), _sum("trip_distance"), 0.0).alias("revenue_per_mile"),
    )
    calendar = {
        "pickup_year": F.year("pickup_date"),
        "pickup_month": F.month("pickup_date"),
        **_weekday_columns(sunday=0),
    }
    return measures.withColumns(calendar).select(
        "pickup_date", "pickup_year", "pickup_month", "pickup_hour", "day_of_week", "day_name",
        "is_weekend", "time_of_day", "pu_location_id", "trip_count", "total_revenue", "avg_fare",
        "avg_distance_miles", "avg_duration_minutes", "avg_tip", "tip_rate_pct", "long_trip_pct",
        "airport_trip_pct", "total_passengers", "revenue_per_mile",
    )


def gold_hour_demo(silver: DataFrame) -> DataFrame:
    """Date x hour KPIs of the ``demo`` silver table (15 columns)."""
    measures = silver.groupBy("pickup_date", "pickup_hour").agg(
        _rows().alias("trip_count"),
        _sum2("total_amount").alias("total_revenue"),
        _avg2("total_amount").alias("avg_fare"),
        _avg2("trip_distance").alias("avg_distance"),
        _avg2("trip_duration_minutes").alias("avg_duration_minutes"),
        _avg2("tip_amount").alias("avg_tip"),
        X.percent_of_rows(F.col("was_tipped"), 1).alias("tip_rate_pct"),
        F.sum("passenger_count").alias("total_passengers"),
        X.guarded_ratio(_sum("total_amount"), _sum("trip_distance"), 0.0).alias("revenue_per_mile"),
    )
    return measures.withColumns(_weekday_columns(sunday=0)).select(
        "pickup_date", "pickup_hour", "time_of_day", "day_of_week", "day_name", "is_weekend",
        "trip_count", "total_revenue", "avg_fare", "avg_distance", "avg_duration_minutes", "avg_tip",
        "tip_rate_pct", "total_passengers", "revenue_per_mile",
    )


def gold_sim(silver: DataFrame) -> DataFrame:
    """Date x hour sums of the ``sim`` silver table, unrounded."""
    return silver.groupBy("pickup_date", "pickup_hour", "time_of_day").agg(
        _rows().alias("trip_count"),
        _sum("total_amount").alias("total_revenue"),
        _sum("trip_distance").alias("total_distance"),
        F.count_if(F.col("tip_amount") > 0).alias("tipped_trips"),
        _sum("tip_pct").alias("total_tip_pct"),
    )


#: Gold tables of each profile: table name -> builder over that profile's silver.
GOLD_TABLES = {
    "dbt": {"daily_summary": gold_daily_summary, "location_performance": gold_location_performance},
    "strict": {"hourly_zone_summary": gold_hour_zone},
    "demo": {"daily_summary": gold_hour_demo},
    "spark": {"daily_summary": gold_spark},
    "sim": {"daily_summary": gold_sim},
}


# ---- ad-hoc reports ------------------------------------------------------------------


def revenue_by_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy("pickup_date").agg(
        X.exact_sum("total_amount").alias("revenue"), _rows().alias("trips")
    )


def pickup_zone_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("pu_location_id").agg(
        _rows().alias("pickups"), X.exact_avg("total_amount").alias("avg_fare")
    )


def gold_totals(gold: DataFrame) -> DataFrame:
    """Totals over an hourly gold table: days, buckets, trips, revenue, revenue per trip."""
    revenue, trips = X.exact_sum("total_revenue"), F.sum("trip_count")
    return gold.agg(
        F.count_distinct("pickup_date").alias("days"),
        _rows().alias("gold_rows"),
        F.coalesce(trips, F.lit(0)).alias("total_trips"),
        F.coalesce(X.round_half_up(revenue, 2), F.lit(0.0)).alias("total_revenue"),
        X.guarded_ratio(revenue, trips).alias("avg_fare"),
    )


def source_stats(trips: DataFrame) -> DataFrame:
    """Totals over raw trips: revenue, miles, averages and credit-card share."""
    return trips.agg(
        _rows().alias("rows"),
        X.round_half_up(X.exact_sum("total_amount"), 2).alias("total_revenue"),
        X.round_half_up(X.exact_avg("total_amount"), 2).alias("avg_fare"),
        X.round_half_up(X.exact_sum("trip_distance"), 1).alias("total_miles"),
        X.round_half_up(X.exact_avg("trip_distance"), 2).alias("avg_distance"),
        X.percent_of_rows(F.col("payment_type") == 1, 1).alias("credit_card_pct"),
    )


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row per layer with its row count."""
    rows = [
        layer.agg(_rows().alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, layer in layers.items()
    ]
    counted = rows[0]
    for row in rows[1:]:
        counted = counted.unionByName(row)
    return counted
