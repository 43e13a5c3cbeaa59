"""DuckDB SQL that computes each registered query independently.

Each statement derives trips from the test tables, then the layers on top, as
named common table expressions.
"""

from __future__ import annotations

from .registry import BOOKMARK, EXPIRE_BEFORE, LISTED_TABLES, LOG_MOMENT, LOG_VERSION, ROLLBACK_AT


def r(value: str, digits: int) -> str:
    """Half-up rounding through an exact decimal."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pct(condition: str, digits: int) -> str:
    return r(f"100.0 * count(*) FILTER (WHERE {condition}) / count(*)", digits)


# ---- trips ---------------------------------------------------------------------------

_TRIP_COLUMNS = """
    CAST({vendor} % 2 + 1 AS INTEGER) AS vendor_id,
    start_at AS pickup_datetime,
    start_at + to_minutes(CAST({minutes} AS INTEGER)) AS dropoff_datetime,
    CAST(CASE WHEN {id} % 101 <> 0 THEN {id} % 11 END AS INTEGER) AS passenger_count,
    CAST({distance} AS DOUBLE) AS trip_distance,
    CAST({id} % 6 + 1 AS INTEGER) AS rate_code_id,
    CASE WHEN {id} % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST({zone} AS INTEGER) AS pu_location_id,
    CAST(({id} * 17 + 5) % 265 + 1 AS INTEGER) AS do_location_id,
    CAST(pay AS INTEGER) AS payment_type,
    CAST(fare_c AS DOUBLE) / 100 AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(tip_c AS DOUBLE) / 100 AS tip_amount,
    CAST(0 AS DOUBLE) AS tolls_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CAST(fare_c + tip_c + 130 AS DOUBLE) / 100 AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge
"""


def _trips(carry: str, table: str, pay: str, fare: str, start: str, **parts: str) -> str:
    columns = _TRIP_COLUMNS.format(**parts)
    return f"""
priced AS (SELECT *, {pay} AS pay, {fare} AS fare_c, {start} AS start_at FROM {table}),
tipped AS (SELECT *, CASE WHEN pay = 1 THEN (fare_c * ({parts['id']} % 6) * 5) // 100 ELSE 0 END AS tip_c FROM priced),
trips AS (SELECT {carry}, {columns} FROM tipped),
timed AS (
  SELECT *,
    CAST(date_diff('second', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60 AS trip_duration_minutes,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week
  FROM trips)"""


EVENT_TRIPS = _trips(
    carry="event_id",
    table="events",
    pay="""CASE WHEN event_type IN ('purchase', 'view') THEN 1 WHEN event_type = 'click' THEN 2
           WHEN event_type = 'signup' THEN 3 WHEN event_id % 2 = 0 THEN 4 ELSE 5 END""",
    fare="CAST(round(value * 100) AS BIGINT)",
    start="date_trunc('second', ts)",
    id="event_id",
    vendor="user_id",
    minutes="(event_id * 7) % 260 - 4",
    distance="""CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 150
                ELSE CAST((event_id * 13) % 3000 AS DOUBLE) / 100 END""",
    zone="CASE WHEN event_id % 2 = 0 THEN (event_id * 31) % 265 + 1 ELSE 131 + (event_id * event_id) % 9 END",
)

LINEITEM_TRIPS = _trips(
    carry="l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity",
    table="lineitem",
    pay="l_partkey % 5 + 1",
    fare="CAST(round(l_extendedprice * 100) AS BIGINT) // 1000",
    start="""l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) + to_minutes(CAST(l_suppkey % 60 AS INTEGER))
             + to_seconds(CAST(l_linenumber AS INTEGER))""",
    id="l_partkey",
    vendor="l_partkey",
    minutes="l_orderkey % 240 + 1",
    distance="l_quantity / 2",
    zone="l_suppkey % 265 + 1",
)

_TRIP = """vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, rate_code_id,
  store_and_fwd_flag, pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
  trip_duration_minutes, pickup_date, pickup_hour, day_of_week"""

# ---- rules: (reason, passes) in order ------------------------------------------------

_SPEED = "trip_distance / nullif(trip_duration_minutes / 60, 0)"
RULES = {
    "dbt": [
        ("missing_pickup_datetime", "pickup_datetime IS NOT NULL"),
        ("missing_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
        ("missing_trip_distance", "trip_distance IS NOT NULL"),
        ("missing_fare_amount", "fare_amount IS NOT NULL"),
        ("missing_total_amount", "total_amount IS NOT NULL"),
        ("distance", "trip_distance >= 0.1 AND trip_distance <= 100"),
        ("fare", "fare_amount >= 1 AND fare_amount <= 500"),
        ("total", "total_amount > 0"),
        ("duration", "trip_duration_minutes >= 1 AND trip_duration_minutes <= 240"),
        ("dropoff_order", "dropoff_datetime > pickup_datetime"),
    ],
    "strict": [
        ("missing_pickup_datetime", "pickup_datetime IS NOT NULL"),
        ("missing_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
        ("distance", "trip_distance > 0 AND trip_distance <= 200"),
        ("fare", "fare_amount > 0 AND fare_amount <= 500"),
        ("total", "total_amount > 0"),
        ("tip", "tip_amount >= 0"),
        ("passengers", "passenger_count > 0 AND passenger_count <= 9"),
        ("duration", "trip_duration_minutes > 0 AND trip_duration_minutes <= 300"),
        ("speed", f"{_SPEED} <= 120"),
    ],
    "demo": [
        ("missing_pickup_datetime", "pickup_datetime IS NOT NULL"),
        ("missing_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
        ("distance", "trip_distance > 0 AND trip_distance <= 200"),
        ("fare", "fare_amount > 0 AND fare_amount <= 500"),
        ("total", "total_amount > 0"),
        ("duration", "trip_duration_minutes > 0 AND trip_duration_minutes <= 300"),
    ],
    "spark": [
        ("distance", "trip_distance > 0"),
        ("fare", "fare_amount > 0"),
        ("total", "total_amount > 0"),
        ("missing_pickup_datetime", "pickup_datetime IS NOT NULL"),
        ("missing_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
        ("duration", "trip_duration_minutes > 0 AND trip_duration_minutes < 300"),
    ],
    "sim": [
        ("missing_pickup_datetime", "pickup_datetime IS NOT NULL"),
        ("missing_dropoff_datetime", "dropoff_datetime IS NOT NULL"),
        ("missing_tip_amount", "tip_amount IS NOT NULL"),
        ("distance", "trip_distance > 0"),
        ("fare", "fare_amount > 0"),
        ("total", "total_amount > 0"),
        ("duration", "trip_duration_minutes > 0"),
    ],
}


def accepted(profile: str) -> str:
    return " AND ".join(f"({test})" for _, test in RULES[profile])


def first_failure(profile: str) -> str:
    cases = " ".join(f"WHEN NOT coalesce({test}, FALSE) THEN '{reason}'" for reason, test in RULES[profile])
    return f"CASE {cases} ELSE 'accepted' END"


# ---- silver --------------------------------------------------------------------------

BUCKET = """CASE WHEN pickup_hour < 6 OR pickup_hour > 22 THEN 'overnight' WHEN pickup_hour < 10 THEN 'morning_rush'
  WHEN pickup_hour < 16 THEN 'midday' WHEN pickup_hour < 20 THEN 'evening_rush' ELSE 'evening' END"""
LABEL = """coalesce(map {1: 'credit_card', 2: 'cash', 3: 'no_charge', 4: 'dispute'}[payment_type], 'unknown')"""


def ratio(top: str, bottom: str, empty: str, digits: int = 2, scale: str = "") -> str:
    return f"CASE WHEN {bottom} > 0 THEN {r(f'{top} / ({bottom}){scale}', digits)} ELSE {empty} END"


def _features(empty: str) -> str:
    return f"""
    {ratio('trip_distance', 'trip_duration_minutes / 60', empty)} AS avg_speed_mph,
    {BUCKET} AS time_of_day,
    {LABEL} AS payment_type_label,
    coalesce(tip_amount > 0, FALSE) AS was_tipped,
    {ratio('tip_amount', 'fare_amount', 'CAST(0 AS DOUBLE)', scale=' * 100')} AS tip_pct,
    {ratio('fare_amount', 'trip_distance', empty)} AS fare_per_mile,
    {ratio('total_amount', 'trip_duration_minutes', empty)} AS revenue_per_minute"""


_CORE = "trip_distance, pu_location_id, do_location_id, payment_type, fare_amount, tip_amount, total_amount"
_DAY = "dayname(pickup_date) AS day_name, day_of_week IN (1, 7) AS is_weekend"
_VIEW = """vendor_id, pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime,
  passenger_count, """ + _CORE + """, trip_duration_minutes, pickup_date, pickup_hour, day_of_week"""
_WHEN = "vendor_id, pickup_datetime, dropoff_datetime, pickup_date, pickup_hour"
_ZERO = "CAST(0 AS DOUBLE)"
_MINUTES2 = f"{r('trip_duration_minutes', 2)} AS trip_duration_minutes"

SILVER = {
    "dbt": f"SELECT {_VIEW}, {_DAY}, {_features('NULL')} FROM timed WHERE {accepted('dbt')}",
    "spark": f"""SELECT {_WHEN}, day_of_week, passenger_count, {_CORE}, trip_duration_minutes
      FROM timed WHERE {accepted('spark')}""",
    "demo": f"""SELECT {_WHEN}, day_of_week - 1 AS day_of_week, {_DAY},
      coalesce(passenger_count, 0) AS passenger_count, {_CORE}, {_MINUTES2}, {_features(_ZERO)}
      FROM timed WHERE {accepted('demo')}""",
    "strict": f"""SELECT {_WHEN}, CAST(year(pickup_date) AS INTEGER) AS pickup_year,
      CAST(month(pickup_date) AS INTEGER) AS pickup_month, CAST(day(pickup_date) AS INTEGER) AS pickup_day,
      day_of_week - 1 AS day_of_week, {_DAY}, rate_code_id, store_and_fwd_flag, passenger_count, {_CORE},
      extra, mta_tax, tolls_amount, improvement_surcharge, congestion_surcharge,
      trip_distance >= 10 AS is_long_trip,
      pu_location_id IN (132, 138) OR do_location_id IN (132, 138) AS is_airport_trip,
      {_MINUTES2}, {_features(_ZERO)}
      FROM timed WHERE {accepted('strict')}""",
    "sim": f"""SELECT {_WHEN}, CAST(isodow(pickup_date) AS INTEGER) AS day_of_week, trip_distance, fare_amount,
      tip_amount, total_amount, {_MINUTES2}, {BUCKET} AS time_of_day,
      {ratio('tip_amount', 'fare_amount', _ZERO, scale=' * 100')} AS tip_pct
      FROM timed WHERE {accepted('sim')}""",
}

# ---- gold ----------------------------------------------------------------------------

HOURLY = f"""SELECT pickup_date, pickup_hour, day_name, is_weekend, time_of_day,
    count(*) AS trip_count,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {r('sum(total_amount)', 2)} AS total_revenue,
    {r('avg(total_amount)', 2)} AS avg_fare,
    {r('sum(fare_amount)', 2)} AS total_fare_amount,
    {r('sum(tip_amount)', 2)} AS total_tips,
    {r('avg(tip_pct)', 2)} AS avg_tip_pct,
    {r('sum(trip_distance)', 2)} AS total_miles,
    {r('avg(trip_distance)', 2)} AS avg_distance,
    {r('avg(trip_duration_minutes)', 2)} AS avg_duration_minutes,
    {r('avg(avg_speed_mph)', 2)} AS avg_speed_mph,
    {r('avg(fare_per_mile)', 2)} AS avg_fare_per_mile,
    {r('avg(revenue_per_minute)', 2)} AS avg_revenue_per_minute,
    count(*) FILTER (WHERE was_tipped) AS tipped_trips,
    {pct('was_tipped', 2)} AS tip_rate_pct,
    count(*) FILTER (WHERE payment_type = 1) AS credit_card_trips,
    count(*) FILTER (WHERE payment_type = 2) AS cash_trips,
    {pct('payment_type = 1', 2)} AS credit_card_pct,
    count(DISTINCT pu_location_id) AS unique_pickup_zones,
    count(DISTINCT do_location_id) AS unique_dropoff_zones
  FROM silver GROUP BY ALL"""

DAILY = f"""SELECT *, hour_rank_by_volume <= 3 AS is_peak_hour,
    {r('total_revenue / trip_count', 2)} AS revenue_per_trip,
    {r('total_passengers / trip_count', 2)} AS avg_passengers_per_trip
  FROM (SELECT *,
      CAST(row_number() OVER (PARTITION BY pickup_date ORDER BY trip_count DESC, pickup_hour) AS INTEGER)
        AS hour_rank_by_volume,
      CAST(row_number() OVER (PARTITION BY pickup_date ORDER BY total_revenue DESC, pickup_hour) AS INTEGER)
        AS hour_rank_by_revenue,
      {r('avg(trip_count) OVER (PARTITION BY pickup_hour ORDER BY pickup_date ROWS 6 PRECEDING)', 1)}
        AS rolling_7d_avg_trips
    FROM hourly)"""

ZONES = f"""SELECT pu_location_id AS location_id,
    count(*) AS trip_count,
    {r('sum(total_amount)', 2)} AS total_revenue,
    {r('avg(total_amount)', 2)} AS avg_fare,
    {r('avg(trip_distance)', 2)} AS avg_distance,
    {r('avg(trip_duration_minutes)', 2)} AS avg_duration_minutes,
    {r('avg(tip_pct)', 2)} AS avg_tip_pct,
    {pct('was_tipped', 2)} AS tip_rate_pct,
    count(DISTINCT pickup_date) AS active_days,
    {r('count(*) / count(DISTINCT pickup_date)', 1)} AS avg_daily_trips
  FROM silver GROUP BY 1"""

LOCATIONS = f"""SELECT *,
    CASE WHEN revenue_rank > 100 THEN 'other' WHEN revenue_rank > 50 THEN 'top_100'
         WHEN revenue_rank > 10 THEN 'top_50' ELSE 'top_10' END AS revenue_tier
  FROM (SELECT *,
      CAST(row_number() OVER (ORDER BY total_revenue DESC, location_id) AS INTEGER) AS revenue_rank,
      CAST(row_number() OVER (ORDER BY trip_count DESC, location_id) AS INTEGER) AS volume_rank,
      CAST(row_number() OVER (ORDER BY avg_fare DESC, location_id) AS INTEGER) AS avg_fare_rank,
      {r('100 * percent_rank() OVER (ORDER BY total_revenue)', 1)} AS revenue_percentile
    FROM zones)"""

_COMMON = f"""count(*) AS trip_count,
    {r('sum(total_amount)', 2)} AS total_revenue,
    {r('avg(total_amount)', 2)} AS avg_fare,
    {r('avg(trip_duration_minutes)', 2)} AS avg_duration_minutes,
    {r('avg(tip_amount)', 2)} AS avg_tip,
    {pct('was_tipped', 1)} AS tip_rate_pct,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {ratio('sum(total_amount)', 'sum(trip_distance)', _ZERO)} AS revenue_per_mile"""

HOUR_ZONE = f"""SELECT pickup_date, pickup_year, pickup_month, pickup_hour, day_of_week, day_name, is_weekend,
    time_of_day, pu_location_id, {_COMMON},
    {r('avg(trip_distance)', 2)} AS avg_distance_miles,
    {pct('is_long_trip', 1)} AS long_trip_pct,
    {pct('is_airport_trip', 1)} AS airport_trip_pct
  FROM silver GROUP BY pickup_date, pickup_year, pickup_month, pickup_hour, day_of_week, day_name, is_weekend,
    time_of_day, pu_location_id"""

HOUR_DEMO = f"""SELECT pickup_date, pickup_hour, time_of_day, day_of_week, day_name, is_weekend, {_COMMON},
    {r('avg(trip_distance)', 2)} AS avg_distance
  FROM silver GROUP BY pickup_date, pickup_hour, time_of_day, day_of_week, day_name, is_weekend"""

GOLD_SPARK = f"""SELECT pickup_date, pickup_hour, day_of_week, trip_count, total_passengers, unique_pickup_zones,
    {r('revenue', 6)} AS total_revenue, {r('fare', 6)} AS avg_fare, {r('miles', 6)} AS avg_distance,
    {r('minutes', 6)} AS avg_duration_minutes, {r('tip', 6)} AS avg_tip,
    {r('CASE WHEN miles > 0 THEN revenue / (trip_count * miles) ELSE 0 END', 6)} AS revenue_per_mile,
    {r('CASE WHEN fare > 0 THEN tip / fare * 100 ELSE 0 END', 6)} AS tip_percentage
  FROM (SELECT pickup_date, pickup_hour, day_of_week, count(*) AS trip_count, sum(total_amount) AS revenue,
      avg(total_amount) AS fare, avg(trip_distance) AS miles, avg(trip_duration_minutes) AS minutes,
      CAST(sum(passenger_count) AS BIGINT) AS total_passengers, avg(tip_amount) AS tip,
      count(DISTINCT pu_location_id) AS unique_pickup_zones
    FROM silver GROUP BY ALL)"""

# ---- incremental and versions --------------------------------------------------------

_NEWEST_UPDATE = """row_number() OVER (PARTITION BY vendor_id, tpep_pickup_datetime, pu_location_id
  ORDER BY tpep_dropoff_datetime DESC, passenger_count DESC NULLS LAST, trip_distance DESC, do_location_id DESC,
    payment_type DESC, fare_amount DESC, tip_amount DESC, total_amount DESC) = 1"""
_MERGED = """SELECT * FROM loaded ANTI JOIN updates
    USING (vendor_id, tpep_pickup_datetime, pu_location_id)
  UNION ALL BY NAME SELECT * FROM updates"""
_CUTOFF = "(SELECT max(pickup_date) - 10 FROM silver)"
_LOADED = f"loaded AS (SELECT * FROM silver WHERE pickup_date <= {_CUTOFF})"

LOG = f"""log AS (SELECT event_id // 14 AS trip_key, event_id, vendor_id, pickup_datetime, pu_location_id,
    trip_distance, fare_amount, total_amount, event_id * 7 % 10 + 1 AS _version,
    TIMESTAMP '2024-02-01' + to_days(CAST(event_id * 7 % 10 + 1 AS INTEGER)) AS _committed_at,
    CASE WHEN event_id % 37 = 0 THEN 'D' ELSE 'U' END AS _op
  FROM timed WHERE {accepted('dbt')})"""


def _last(source: str, condition: str = "TRUE") -> str:
    return f"""SELECT * FROM {source} WHERE {condition}
      QUALIFY row_number() OVER (PARTITION BY trip_key ORDER BY _version DESC, event_id DESC) = 1"""


def _live(condition: str) -> str:
    return f"SELECT * EXCLUDE (_op) FROM ({_last('log', condition)}) WHERE _op = 'U'"


_PAYLOAD = "event_id, vendor_id, pickup_datetime, pu_location_id, trip_distance, fare_amount, total_amount"

ROLLBACK = f"""
SELECT trip_key, {", ".join(f"CASE WHEN change = 'U' THEN b.{c} ELSE a.{c} END AS {c}" for c in _PAYLOAD.split(", "))},
  (SELECT max(_version) + 1 FROM log) AS _version, TIMESTAMP '{ROLLBACK_AT}' AS _committed_at, change AS _op
FROM (SELECT a, b, trip_key,
    CASE WHEN b IS NOT NULL AND NOT (a._op = 'U' AND b.event_id = a.event_id) THEN 'U'
         WHEN b IS NULL AND a._op = 'U' THEN 'D' END AS change
  FROM (SELECT trip_key, a FROM ({_last('log', f'_version > {LOG_VERSION}')}) AS a)
  LEFT JOIN (SELECT trip_key, b FROM ({_live(f'_version <= {LOG_VERSION}')}) AS b) USING (trip_key))
WHERE change IS NOT NULL"""

EXPIRE = f"""
, history AS (SELECT _version, min(_committed_at) AS committed FROM log GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY _version DESC) AS recency FROM history),
edge AS (SELECT min(_version) AS horizon FROM ranked WHERE committed >= TIMESTAMP '{EXPIRE_BEFORE}' OR recency <= 3),
gone AS (SELECT log.* FROM log, edge WHERE _version < horizon)
SELECT * REPLACE ((SELECT max(_version) FROM gone) AS _version, (SELECT max(_committed_at) FROM gone) AS _committed_at)
FROM ({_last('gone')}) WHERE _op = 'U'
UNION ALL BY NAME SELECT log.* FROM log, edge WHERE _version >= horizon"""

# ---- data quality --------------------------------------------------------------------


def _report(rows: str, rules: dict[str, str], prefix: str = "") -> str:
    """One SELECT per rule; ``rules`` maps a name to the condition a good row meets."""
    return " UNION ALL ".join(
        f"""SELECT {prefix} '{name}' AS rule, count(*) AS checked,
          count(*) FILTER (WHERE NOT coalesce({good}, FALSE)) AS failed,
          count(*) FILTER (WHERE NOT coalesce({good}, FALSE)) = 0 AS passed FROM {rows}"""
        for name, good in rules.items()
    )


def _not_null(layer: str, rows: str, columns: str) -> str:
    rules = {f"not_null:{name}": f"{name} IS NOT NULL" for name in columns.split()}
    return _report(rows, rules, prefix=f"'{layer}' AS layer,")


_BUCKETS = "time_of_day IN ('morning_rush', 'midday', 'evening_rush', 'evening', 'overnight')"
_DEMO_RULES = {
    "distance_range": "trip_distance > 0 AND trip_distance <= 200",
    "fare_range": "fare_amount > 0 AND fare_amount <= 500",
    "duration_range": "trip_duration_minutes > 0 AND trip_duration_minutes <= 300",
    "time_of_day_values": _BUCKETS,
}
_STRICT_RULES = _DEMO_RULES | {
    "total_positive": "total_amount > 0",
    "passenger_range": "passenger_count BETWEEN 1 AND 9",
    "speed_range": "avg_speed_mph > 0 AND avg_speed_mph < 120",
    "tip_pct_not_negative": "tip_pct >= 0",
    "pickup_date_format": r"regexp_full_match(CAST(pickup_date AS VARCHAR), '\d{4}-\d{2}-\d{2}')",
    "payment_label_present": "payment_type_label <> ''",
}
_ACCEPTED = {
    "accepted_values:vendor_id": "(vendor_id IS NULL OR vendor_id IN (1, 2))",
    "accepted_values:payment_type": "(payment_type IS NULL OR payment_type BETWEEN 1 AND 6)",
    "accepted_values:payment_type_label": """(payment_type_label IS NULL OR payment_type_label IN
      ('credit_card', 'cash', 'no_charge', 'dispute', 'unknown'))""",
    "accepted_values:time_of_day": f"(time_of_day IS NULL OR {_BUCKETS})",
}
_BAD_DURATION = """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_minutes FROM {rows}
  WHERE trip_duration_minutes <= 0 OR tpep_dropoff_datetime <= tpep_pickup_datetime"""


# ---- assembly ------------------------------------------------------------------------


def _sql(final: str, *tables: str, trips: str = EVENT_TRIPS) -> str:
    return "WITH " + ",\n".join([trips.strip(), *tables]) + "\n" + final


def _as(name: str, body: str) -> str:
    return f"{name} AS ({body})"


def _silver(profile: str) -> str:
    return _as("silver", SILVER[profile])


#: Queries whose result has a date column, and its name.
DATE_COLUMNS = {
    **dict.fromkeys(
        [f"{kind}_{profile}" for kind in ("clean", "silver") for profile in RULES]
        + """raw_trips partition_manifest gold_daily_hourly gold_daily_summary gold_daily_summary_lineitem gold_spark
        gold_hour_zone gold_hour_demo gold_sim revenue_by_day top_revenue_hours merge_upsert incremental_filter
        incremental_run dq_gold_revenue dq_gold_revenue_refunded clean_replaced_thresholds""".split(),
        "pickup_date",
    ),
    "watermark": "watermark",
}


def _untidy_sql(empty: str, flag: str | None, absent: str) -> str:
    """``events`` as untidy text, typed again: ``empty`` and ``flag`` stand for blank cells."""
    blank = f"coalesce(nullif(trim(flag), ''), {flag})" if flag else "flag"
    return f"""
      WITH cells AS (
        SELECT CAST(event_id AS VARCHAR) AS vendor, CASE WHEN event_id % 7 = 0 THEN NULL ELSE '2024-01-02 03:04:05' END AS start_at,
          CASE WHEN event_id % 5 = 0 THEN '  ' ELSE ' Y' END AS flag, CASE WHEN event_id % 3 = 0 THEN '2.0' ELSE ' 3' END AS people,
          CASE WHEN event_id % 11 = 0 THEN {empty} WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
               ELSE CAST(event_id % 900 AS VARCHAR) || '.25' END AS fare
        FROM events)
      SELECT CAST(vendor AS INTEGER) AS vendor_id, start_at AS pickup_text, {blank} AS store_and_fwd_flag,
        CAST(CAST(trim(people) AS DOUBLE) AS INTEGER) AS passenger_count, CAST(fare AS DOUBLE) AS fare_amount,
        {absent.format(kind="DOUBLE")} AS tip_amount, {absent.format(kind="INTEGER")} AS payment_type
      FROM cells"""


def oracles() -> dict[str, str]:
    hourly, zones, zone_rows = _as("hourly", HOURLY), _as("zones", ZONES), _as("gold", HOUR_ZONE)
    dbt, strict, view = _silver("dbt"), _silver("strict"), _as("view15", f"SELECT {_VIEW} FROM timed")
    sql = {
        "raw_trips": _sql("SELECT * FROM view15", view),
        "partition_granularity": _sql(
            " UNION ALL ".join(
                f"""SELECT '{grain}' AS granularity,
                  CAST(date_trunc('{grain}', pickup_datetime) AS TIMESTAMP) AS partition_start,
                  count(*) AS rows FROM trips GROUP BY 2"""
                for grain in ("hour", "day", "month", "year")
            )
        ),
        "partition_manifest": _sql(
            """SELECT pickup_date, count(*) AS rows, min(pickup_datetime) AS min_pickup_datetime,
              max(pickup_datetime) AS max_pickup_datetime FROM silver GROUP BY 1""",
            _silver("spark"),
        ),
        "incremental_extract": f"""SELECT user_id AS id, ts AS updated_at, event_id, event_type, value FROM events
          WHERE ts >= TIMESTAMP '{BOOKMARK}'
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "incremental_bookmark": "SELECT max(ts) AS bookmark FROM events",
        "dedupe_latest": _sql(
            """SELECT vendor_id, pickup_datetime, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              l_quantity, pu_location_id, fare_amount, total_amount FROM trips
            QUALIFY row_number() OVER (PARTITION BY vendor_id, pickup_datetime ORDER BY l_orderkey DESC,
              l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) = 1""",
            trips=LINEITEM_TRIPS,
        ),
        "reject_summary": _sql(
            " UNION ALL ".join(
                f"""SELECT '{profile}' AS profile, {first_failure(profile)} AS reject_reason, count(*) AS rows,
                  {r('100.0 * count(*) / (SELECT count(*) FROM trips)', 1)} AS rate_pct
                FROM timed GROUP BY 2"""
                for profile in RULES
            )
        ),
        "safe_divide": _sql(
            """SELECT event_id, CASE WHEN trip_distance <> 0 THEN fare_amount / trip_distance ELSE 0 END AS fare_per_mile,
              CASE WHEN passenger_count <> 0 THEN total_amount / passenger_count ELSE -1 END AS total_per_passenger
            FROM trips"""
        ),
        "distance_class": _sql(
            """SELECT event_id, trip_distance, CASE WHEN trip_distance IS NULL OR trip_distance >= 15 THEN 'very_long'
              WHEN trip_distance >= 5 THEN 'long' WHEN trip_distance >= 1 THEN 'medium' ELSE 'short' END AS distance_class
            FROM trips"""
        ),
        "business_hours": _sql(
            "SELECT event_id, pickup_hour, pickup_hour BETWEEN 8 AND 18 AS is_business_hours FROM timed"
        ),
        "gold_daily_hourly": _sql("SELECT * FROM hourly", dbt, hourly),
        "gold_daily_summary": _sql(DAILY, dbt, hourly),
        "gold_daily_summary_lineitem": _sql(DAILY, dbt, hourly, trips=LINEITEM_TRIPS),
        "zone_stats": _sql("SELECT * FROM zones", dbt, zones),
        "gold_location_performance": _sql(LOCATIONS, dbt, zones),
        "gold_location_performance_lineitem": _sql(LOCATIONS, dbt, zones, trips=LINEITEM_TRIPS),
        "gold_spark": _sql(GOLD_SPARK, _silver("spark")),
        "gold_hour_zone": _sql("SELECT * FROM gold", strict, zone_rows),
        "gold_hour_demo": _sql(HOUR_DEMO, _silver("demo")),
        "gold_sim": _sql(
            f"""SELECT pickup_date, pickup_hour, time_of_day, count(*) AS trip_count,
              {r('sum(total_amount)', 6)} AS total_revenue, {r('sum(trip_distance)', 6)} AS total_distance,
              count(*) FILTER (WHERE tip_amount > 0) AS tipped_trips, {r('sum(tip_pct)', 6)} AS total_tip_pct
            FROM silver GROUP BY 1, 2, 3""",
            _silver("sim"),
        ),
        "revenue_by_day": _sql(
            f"SELECT pickup_date, {r('sum(total_amount)', 6)} AS revenue, count(*) AS trips FROM silver GROUP BY 1",
            _silver("spark"),
        ),
        "gold_totals": _sql(
            f"""SELECT count(DISTINCT pickup_date) AS days, count(*) AS gold_rows,
              CAST(sum(trip_count) AS BIGINT) AS total_trips, {r('sum(total_revenue)', 2)} AS total_revenue,
              {r('sum(total_revenue) / sum(trip_count)', 2)} AS avg_fare FROM gold""",
            strict, zone_rows,
        ),
        "source_stats": _sql(
            f"""SELECT count(*) AS rows, {r('sum(total_amount)', 2)} AS total_revenue,
              {r('avg(total_amount)', 2)} AS avg_fare, {r('sum(trip_distance)', 1)} AS total_miles,
              {r('avg(trip_distance)', 2)} AS avg_distance, {pct('payment_type = 1', 1)} AS credit_card_pct FROM trips"""
        ),
        "layer_counts": _sql(
            """SELECT 'raw' AS layer, count(*) AS rows FROM trips
            UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM hourly""",
            dbt, hourly,
        ),
        "top_revenue_hours": _sql(
            """SELECT pickup_date, pickup_hour, time_of_day, trip_count, total_revenue, avg_fare, pu_location_id,
              tip_rate_pct FROM gold ORDER BY total_revenue DESC, pickup_date, pickup_hour, pu_location_id LIMIT 5""",
            strict, zone_rows,
        ),
        "top_pickup_zones": _sql(
            f"""SELECT pu_location_id, count(*) AS pickups, {r('avg(total_amount)', 6)} AS avg_fare FROM silver
            GROUP BY 1 ORDER BY pickups DESC, pu_location_id LIMIT 20""",
            _silver("spark"),
        ),
        "merge_upsert": _sql(
            _MERGED, dbt, _LOADED,
            f"""updates AS (SELECT * REPLACE (CASE WHEN pickup_date <= {_CUTOFF} THEN fare_amount + 1
                ELSE fare_amount END AS fare_amount)
              FROM silver WHERE pickup_date >= {_CUTOFF} - 3 QUALIFY {_NEWEST_UPDATE})""",
        ),
        "incremental_filter": _sql(f"SELECT * FROM silver WHERE pickup_date >= {_CUTOFF}", dbt),
        "watermark": _sql("SELECT coalesce(max(pickup_date), DATE '2019-01-01') AS watermark FROM silver", dbt),
        "incremental_run": _sql(
            _MERGED, dbt, _LOADED,
            f"""updates AS (SELECT * FROM silver WHERE pickup_date >= (SELECT max(pickup_date) FROM loaded)
              QUALIFY {_NEWEST_UPDATE})""",
        ),
        "as_of_version": _sql(_live(f"_version <= {LOG_VERSION}"), LOG),
        "as_of_timestamp": _sql(_live(f"_committed_at <= TIMESTAMP '{LOG_MOMENT}'"), LOG),
        "totals_at_version": _sql(
            f"""SELECT count(*) AS rows, {r('sum(total_amount)', 6)} AS total_amount
            FROM ({_live(f"_version <= {LOG_VERSION}")})""",
            LOG,
        ),
        "version_history": _sql(
            """SELECT _version, min(_committed_at) AS _committed_at, count(*) AS changes,
              count(*) FILTER (WHERE _op = 'U') AS upserts, count(*) FILTER (WHERE _op = 'D') AS deletes
            FROM log GROUP BY 1""",
            LOG,
        ),
        "rollback_to_version": _sql(ROLLBACK, LOG),
        "expire_versions": _sql("", LOG) + EXPIRE,
        "dq_not_null": _sql(
            " UNION ALL ".join([
                _not_null("raw", "trips", "vendor_id pickup_datetime dropoff_datetime"),
                _not_null("silver", "silver", """vendor_id tpep_pickup_datetime tpep_dropoff_datetime trip_distance
                  payment_type_label fare_amount total_amount time_of_day day_name is_weekend was_tipped"""),
                _not_null("gold", "daily", """pickup_date pickup_hour day_name is_weekend time_of_day trip_count
                  total_revenue avg_fare is_peak_hour"""),
            ]),
            dbt, hourly, _as("daily", DAILY),
        ),
        "dq_accepted_values": _sql(_report("silver", _ACCEPTED), dbt),
        "dq_gold_revenue": _sql(
            "SELECT pickup_date, pickup_hour, total_revenue FROM hourly WHERE total_revenue <= 0", dbt, hourly
        ),
        "dq_silver_duration": _sql(_BAD_DURATION.format(rows="silver"), dbt),
        "dq_raw_duration": _sql(_BAD_DURATION.format(rows="view15"), view),
        "dq_report_strict": _sql(_report("silver", _STRICT_RULES), strict),
        "dq_report_demo": _sql(_report("silver", _DEMO_RULES), _silver("demo")),
        "dq_sim": _sql(
            """SELECT 'not_empty' AS rule, count(*) AS checked, CAST(count(*) = 0 AS BIGINT) AS failed,
              count(*) > 0 AS passed FROM silver UNION ALL """
            + _report("silver", {
                "distance_positive": "trip_distance > 0",
                "fare_positive": "fare_amount > 0",
                "duration_positive": "trip_duration_minutes > 0",
            }),
            _silver("sim"),
        ),
    }
    replaced = accepted("dbt").replace("trip_duration_minutes >= 1 AND trip_duration_minutes <= 240", "trip_duration_minutes >= 0 AND trip_duration_minutes <= 120")
    replaced = replaced.replace("fare_amount >= 1 AND fare_amount <= 500", "fare_amount >= 3 AND fare_amount <= 60")
    refunded = _as("silver", f"SELECT * REPLACE (total_amount - 60 AS total_amount) FROM ({SILVER['dbt']})")
    sql |= {
        "clean_replaced_thresholds": _sql(f"SELECT {_TRIP} FROM timed WHERE {replaced}"),
        "dq_gold_revenue_refunded": _sql("SELECT pickup_date, pickup_hour, total_revenue FROM hourly WHERE total_revenue <= 0", refunded, hourly),
        "lenient_text": _untidy_sql(empty="'0'", flag="'N'", absent="CAST(0 AS {kind})"),
        "conform_text": _untidy_sql(empty="NULL", flag=None, absent="CAST(NULL AS {kind})"),
        "schema_evolution": """SELECT event_id, user_id, event_type, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_id % 2 = 0
          UNION ALL SELECT event_id, CAST(NULL AS BIGINT), event_type, value FROM events WHERE event_id % 2 = 1""",
        "file_listing": " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", '{name}.parquet' AS file_name, count(*) AS rows, TRUE AS has_bytes FROM {name}" for name in LISTED_TABLES
        ),
        "merge_upsert_incomplete_keys": """
          WITH t AS (SELECT CASE WHEN event_id % 10 <> 0 THEN user_id END AS k, event_id, event_type FROM events WHERE event_id % 3 = 0),
          u AS (SELECT CASE WHEN event_id % 10 <> 0 THEN user_id END AS k, event_id, event_type FROM events WHERE event_id % 3 = 1)
          SELECT * FROM t WHERE k IS NULL OR k NOT IN (SELECT k FROM u WHERE k IS NOT NULL)
          UNION ALL SELECT * FROM u WHERE k IS NULL
          UNION ALL (SELECT * FROM u WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY event_id DESC) = 1)""",
    }
    for profile in RULES:
        sql[f"clean_{profile}"] = _sql(f"SELECT {_TRIP} FROM timed WHERE {accepted(profile)}")
        sql[f"silver_{profile}"] = _sql("SELECT * FROM silver", _silver(profile))
    return sql
