"""Typed trips derived from the ``events`` and ``lineitem`` tables.

The test tables hold no trips.  These projections derive all trip columns from
one table with integer arithmetic, row by row, so they scan once, shuffle
nothing, and grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..schemas import TRIP_SCHEMA

_TRIPS = """
  cast({vendor} % 2 + 1 as int)                                  as vendor_id,
  {pickup}                                                       as pickup_datetime,
  {pickup} + ({minutes}) * interval '1' minute                   as dropoff_datetime,
  cast(if({id} % 101 = 0, null, {id} % 11) as int)               as passenger_count,
  cast({distance} as double)                                     as trip_distance,
  cast({id} % 6 + 1 as int)                                      as rate_code_id,
  if({id} % 50 = 0, 'Y', 'N')                                    as store_and_fwd_flag,
  cast({pickup_zone} as int)                                     as pu_location_id,
  cast(({id} * 17 + 5) % 265 + 1 as int)                         as do_location_id,
  cast(_payment as int)                                          as payment_type,
  _fare / 100.0d                                                 as fare_amount,
  0.5d                                                           as extra,
  0.5d                                                           as mta_tax,
  _tip / 100.0d                                                  as tip_amount,
  0.0d                                                           as tolls_amount,
  0.3d                                                           as improvement_surcharge,
  (_fare + _tip + 130) / 100.0d                                  as total_amount,
  2.5d                                                           as congestion_surcharge
"""


def _derive(table: DataFrame, carry: list[str], payment: str, fare: str, **parts: str) -> DataFrame:
    cents = table.selectExpr("*", f"{payment} as _payment", f"{fare} as _fare")
    tip = f"if(_payment = 1, (_fare * ({parts['id']} % 6) * 5) div 100, 0) as _tip"
    columns = [line.strip() for line in _TRIPS.format(**parts).strip().split(",\n")]
    trips = cents.selectExpr("*", tip).selectExpr(*carry, *columns)
    return trips.select(*carry, *TRIP_SCHEMA.names)


def trips_from_events(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One trip per event; ``carry`` keeps event columns next to it."""
    return _derive(
        spark.read.parquet(f"{sf_dir}/events.parquet"),
        list(carry),
        payment=(
            "case event_type when 'purchase' then 1 when 'view' then 1 when 'click' then 2 "
            "when 'signup' then 3 else if(event_id % 2 = 0, 4, 5) end"
        ),
        fare="cast(round(value * 100) as bigint)",
        id="event_id",
        vendor="user_id",
        # the event's second: whole seconds since 1970, free of any session time zone
        pickup="(timestamp_ntz'1970-01-01 00:00:00' + unix_timestamp(ts) * interval '1' second)",
        minutes="(event_id * 7) % 260 - 4",
        distance=(
            "case when event_id % 103 = 0 then null when event_id % 97 = 0 then 150.0d "
            "else ((event_id * 13) % 3000) / 100.0d end"
        ),
        pickup_zone="if(event_id % 2 = 0, (event_id * 31) % 265 + 1, 131 + (event_id * event_id) % 9)",
    )


def trips_from_lineitem(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One trip per line item, the larger of the two tables."""
    return _derive(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"),
        list(carry),
        payment="cast(l_partkey % 5 + 1 as int)",
        fare="cast(round(l_extendedprice * 100) as bigint) div 1000",
        id="l_partkey",
        vendor="l_partkey",
        pickup=(
            "(l_shipdate + (l_partkey % 24 * 3600 + l_suppkey % 60 * 60 + l_linenumber) * interval '1' second)"
        ),
        minutes="l_orderkey % 240 + 1",
        distance="l_quantity / 2",
        pickup_zone="l_suppkey % 265 + 1",
    )


# ---- inputs of the incremental and versioned operators --------------------------------

LOG_KEYS = ("trip_key",)
LOG_PAYLOAD = (
    "event_id",
    "vendor_id",
    "pickup_datetime",
    "pu_location_id",
    "trip_distance",
    "fare_amount",
    "total_amount",
)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned changes of accepted trips: up to 14 changes per key over 10 versions.

    A key covers a run of 14 events, so the number of keys grows with the table.
    Two changes of a key in one version are told apart by ``event_id``.
    """
    trips = clean(trips_from_events(spark, sf_dir, carry=("event_id",)), "dbt")
    return trips.selectExpr(
        "event_id div 14 as trip_key",
        *LOG_PAYLOAD,
        "(event_id * 7) % 10 + 1 as _version",
        "timestamp_ntz'2024-02-01 00:00:00' + ((event_id * 7) % 10 + 1) * interval '1' day as _committed_at",
        "if(event_id % 37 = 0, 'D', 'U') as _op",
    )


def silver_cutoff(silver: DataFrame) -> Column:
    """Day up to which the incremental examples count as loaded: ten days before the newest."""
    return silver.agg(F.date_sub(F.max("pickup_date"), 10)).scalar()


def merge_inputs(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(target, updates): history up to the cutoff, and newer trips plus three corrected days."""
    cutoff, day = silver_cutoff(silver), F.col("pickup_date")
    loaded = silver.filter(day <= cutoff)
    corrected = F.when(day <= cutoff, F.col("fare_amount") + 1).otherwise(F.col("fare_amount"))
    incoming = silver.filter(day >= F.date_sub(cutoff, 3)).withColumn("fare_amount", corrected)
    return loaded, incoming
