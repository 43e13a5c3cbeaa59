"""Fixed column sets: raw trips, typed trips, and the silver tables.

Timestamps are ``timestamp_ntz``: trip times are wall-clock times, so hours,
dates and durations must not move with the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column order, names and types.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

# Raw name -> name used by every operator (others keep theirs).
TRIP_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}
RAW_NAMES = {trip: raw for raw, trip in TRIP_NAMES.items()}

#: Typed trips: the raw columns under their operator names.
TRIP_SCHEMA = T.StructType(
    [T.StructField(TRIP_NAMES.get(f.name, f.name), f.dataType) for f in RAW_SCHEMA]
)

# Silver column orders.  ``spark`` is the plain cleaned table, the
# others add features.
SILVER_COLUMNS = {
    "spark": (
        "vendor_id pickup_datetime dropoff_datetime pickup_date pickup_hour day_of_week "
        "passenger_count trip_distance pu_location_id do_location_id payment_type fare_amount "
        "tip_amount total_amount trip_duration_minutes"
    ).split(),
    "dbt": (
        "vendor_id tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance "
        "pu_location_id do_location_id payment_type fare_amount tip_amount total_amount "
        "trip_duration_minutes pickup_date pickup_hour day_of_week avg_speed_mph time_of_day "
        "day_name is_weekend payment_type_label was_tipped tip_pct fare_per_mile "
        "revenue_per_minute"
    ).split(),
    "strict": (
        "vendor_id pickup_datetime dropoff_datetime pickup_date pickup_year pickup_month "
        "pickup_day pickup_hour day_of_week day_name is_weekend pu_location_id do_location_id "
        "rate_code_id store_and_fwd_flag passenger_count fare_amount extra mta_tax tip_amount "
        "tolls_amount improvement_surcharge congestion_surcharge total_amount payment_type "
        "payment_type_label trip_distance trip_duration_minutes avg_speed_mph time_of_day "
        "was_tipped tip_pct fare_per_mile revenue_per_minute is_long_trip is_airport_trip"
    ).split(),
    "demo": (
        "vendor_id pickup_datetime dropoff_datetime pickup_date pickup_hour day_of_week day_name "
        "is_weekend passenger_count trip_distance pu_location_id do_location_id payment_type "
        "payment_type_label fare_amount tip_amount total_amount trip_duration_minutes "
        "avg_speed_mph time_of_day was_tipped tip_pct fare_per_mile revenue_per_minute"
    ).split(),
    "sim": (
        "vendor_id pickup_datetime dropoff_datetime pickup_date pickup_hour day_of_week "
        "trip_distance fare_amount tip_amount total_amount trip_duration_minutes time_of_day "
        "tip_pct"
    ).split(),
}

#: Columns of the typed view the ``dbt`` silver model reads.
RAW_VIEW_COLUMNS = SILVER_COLUMNS["dbt"][:15]

#: Key of the incremental silver table.
MERGE_KEYS = ("vendor_id", "tpep_pickup_datetime", "pu_location_id")

#: Key used to drop repeated raw records on ingest.
INGEST_KEYS = ("vendor_id", "pickup_datetime")
