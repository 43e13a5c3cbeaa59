"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole tables.  Results that are plain float sums or averages
are rounded to six decimals here (:func:`settle`), because their last bits
depend on the order rows are added up; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import clean as C
from ..operators import gold as G
from ..operators import quality as Q
from ..operators import ranking as R
from ..operators import upsert as U
from ..operators import versions as V
from ..operators.silver import build_silver, newest_first, raw_trips
from ..profiles import PROFILES, between
from ..schemas import INGEST_KEYS, MERGE_KEYS
from ..sources import adapters as A
from ..sources import layout as L
from ..sources.readers import conform, lenient_trips

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Parameters of the registered queries; the SQL checks use the same ones.
BOOKMARK = "2024-01-16 00:00:00"
LOG_VERSION = 6
LOG_MOMENT = "2024-02-07 12:00:00"
ROLLBACK_AT = "2024-02-12 00:00:00"
EXPIRE_BEFORE = "2024-02-05 00:00:00"
LOG_ORDER = ("event_id",)


def query(function: Query) -> Query:
    """Register a query under the function's name (a leading ``q_`` is dropped)."""
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def settle(rows: DataFrame, *columns: str) -> DataFrame:
    """Round order-dependent float results."""
    return rows.withColumns({name: X.round_half_up(name, 6) for name in columns})


def _silver(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    return build_silver(A.trips_from_events(spark, sf_dir), profile)


def _log_tiebreak() -> list:
    return [F.desc(name) for name in LOG_ORDER]


# ---- sources and layout --------------------------------------------------------------


@query
def q_raw_trips(spark, sf_dir):
    return raw_trips(A.trips_from_events(spark, sf_dir))


@query
def partition_granularity(spark, sf_dir):
    return L.partition_counts(A.trips_from_events(spark, sf_dir), "pickup_datetime")


@query
def partition_manifest(spark, sf_dir):
    return L.partition_manifest(_silver(spark, sf_dir, "spark"))


@query
def incremental_extract(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    records = events.select(F.col("user_id").alias("id"), F.col("ts").alias("updated_at"), "event_id", "event_type", "value")
    bookmark = F.lit(BOOKMARK).cast("timestamp_ntz")
    return U.incremental_extract(records, ["id"], "updated_at", bookmark, [F.desc("event_id")])


@query
def incremental_bookmark(spark, sf_dir):
    return U.next_bookmark(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")


@query
def dedupe_latest(spark, sf_dir):
    carried = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    trips = A.trips_from_lineitem(spark, sf_dir, carry=carried)
    newest = U.dedupe_latest(trips, INGEST_KEYS, [F.desc(name) for name in carried])
    return newest.select(*INGEST_KEYS, *carried, "pu_location_id", "fare_amount", "total_amount")


def untidy_text(spark, sf_dir):
    """``events`` as raw text cells, some blank, padded or no number, without two of the raw columns."""
    number = F.when(F.col("event_id") % 11 == 0, "").when(F.col("event_id") % 13 == 0, "n/a").when(F.col("event_id") % 17 == 0, "nan")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").cast("string").alias("VendorID"),
        F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.lit("2024-01-02 03:04:05")).alias("tpep_pickup_datetime"),
        F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.lit(" Y")).alias("store_and_fwd_flag"),
        F.when(F.col("event_id") % 3 == 0, "2.0").otherwise(F.lit(" 3")).alias("passenger_count"),
        number.otherwise(F.concat(F.lit(" "), (F.col("event_id") % 900).cast("string"), F.lit(".25 "))).alias("fare_amount"),
        (F.col("event_id") % 9).cast("string").alias("column_no_schema_has"),
    )


UNTIDY_COLUMNS = ("vendor_id", "pickup_text", "store_and_fwd_flag", "passenger_count", "fare_amount", "tip_amount", "payment_type")


def _untidy(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_text", F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")).select(*UNTIDY_COLUMNS)


@query
def lenient_text(spark, sf_dir):
    return _untidy(lenient_trips(untidy_text(spark, sf_dir)))


@query
def conform_text(spark, sf_dir):
    return _untidy(conform(untidy_text(spark, sf_dir)))


@query
def schema_evolution(spark, sf_dir):
    """Rows written before and after a column was added and another dropped."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    older = events.filter("event_id % 2 = 0").select("event_id", "user_id", "event_type")
    newer = events.filter("event_id % 2 = 1").select("event_id", "value", "event_type")
    return V.read_together(older, newer)


LISTED_TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")


@query
def file_listing(spark, sf_dir):
    """The files of several tables: a row per table and file."""
    listed = [L.list_files(spark.read.parquet(f"{sf_dir}/{name}.parquet")).withColumn("table", F.lit(name)) for name in LISTED_TABLES]
    files = reduce(DataFrame.unionByName, listed)
    name = F.element_at(F.split("file_path", "/"), -1)
    return files.select("table", name.alias("file_name"), "rows", (F.col("bytes") > 0).alias("has_bytes"))


# ---- cleaning ------------------------------------------------------------------------


def _clean(profile: str) -> Query:
    return lambda spark, sf_dir: C.clean(A.trips_from_events(spark, sf_dir), profile)


def _silver_query(profile: str) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, profile)


for _profile in ("dbt", "strict", "demo", "spark", "sim"):
    QUERIES[f"clean_{_profile}"] = _clean(_profile)
    QUERIES[f"silver_{_profile}"] = _silver_query(_profile)


#: The ``dbt`` rules with a zero lower bound of the duration and other fares; the order of times still counts.
REPLACED = replace(
    PROFILES["dbt"],
    gates=tuple(
        between("duration", "trip_duration_minutes", 0.0, 120.0) if g.reason == "duration" else between("fare", "fare_amount", 3.0, 60.0) if g.reason == "fare" else g
        for g in PROFILES["dbt"].gates
    ),
)


@query
def clean_replaced_thresholds(spark, sf_dir):
    return C.clean(A.trips_from_events(spark, sf_dir), REPLACED)


@query
def reject_summary(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir)
    return C.reject_summary(trips, "dbt", "strict", "demo", "spark", "sim")


# ---- scalar helpers ------------------------------------------------------------------


@query
def safe_divide(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir, carry=("event_id",))
    return trips.select(
        "event_id",
        X.safe_divide("fare_amount", "trip_distance").alias("fare_per_mile"),
        X.safe_divide("total_amount", "passenger_count", -1).alias("total_per_passenger"),
    )


@query
def distance_class(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir, carry=("event_id",))
    return trips.select("event_id", "trip_distance", X.distance_class("trip_distance").alias("distance_class"))


@query
def business_hours(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir, carry=("event_id",))
    hour = F.hour("pickup_datetime")
    return trips.select("event_id", hour.alias("pickup_hour"), X.business_hours(hour).alias("is_business_hours"))


# ---- gold ----------------------------------------------------------------------------


@query
def gold_daily_hourly(spark, sf_dir):
    return G.gold_daily_hourly(_silver(spark, sf_dir, "dbt"))


@query
def gold_daily_summary(spark, sf_dir):
    return G.gold_daily_summary(_silver(spark, sf_dir, "dbt")).orderBy("pickup_date", "pickup_hour")


@query
def gold_daily_summary_lineitem(spark, sf_dir):
    silver = build_silver(A.trips_from_lineitem(spark, sf_dir), "dbt")
    return G.gold_daily_summary(silver).orderBy("pickup_date", "pickup_hour")


@query
def zone_stats(spark, sf_dir):
    return G.zone_stats(_silver(spark, sf_dir, "dbt"))


@query
def gold_location_performance(spark, sf_dir):
    return G.gold_location_performance(_silver(spark, sf_dir, "dbt")).orderBy("revenue_rank")


@query
def gold_location_performance_lineitem(spark, sf_dir):
    silver = build_silver(A.trips_from_lineitem(spark, sf_dir), "dbt")
    return G.gold_location_performance(silver).orderBy("revenue_rank")


@query
def gold_spark(spark, sf_dir):
    gold = G.gold_spark(_silver(spark, sf_dir, "spark"))
    unrounded = "total_revenue avg_fare avg_distance avg_duration_minutes avg_tip revenue_per_mile tip_percentage"
    return settle(gold, *unrounded.split())


@query
def gold_hour_zone(spark, sf_dir):
    return G.gold_hour_zone(_silver(spark, sf_dir, "strict"))


@query
def gold_hour_demo(spark, sf_dir):
    return G.gold_hour_demo(_silver(spark, sf_dir, "demo"))


@query
def gold_sim(spark, sf_dir):
    gold = G.gold_sim(_silver(spark, sf_dir, "sim"))
    return settle(gold, "total_revenue", "total_distance", "total_tip_pct")


@query
def revenue_by_day(spark, sf_dir):
    return settle(G.revenue_by_day(_silver(spark, sf_dir, "spark")), "revenue").orderBy("pickup_date")


@query
def gold_totals(spark, sf_dir):
    return G.gold_totals(G.gold_hour_zone(_silver(spark, sf_dir, "strict")))


@query
def source_stats(spark, sf_dir):
    return G.source_stats(A.trips_from_events(spark, sf_dir))


@query
def layer_counts(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir)
    silver = build_silver(trips, "dbt")
    return G.layer_counts(raw=trips, silver=silver, gold=G.gold_daily_hourly(silver))


@query
def top_revenue_hours(spark, sf_dir):
    return R.top_revenue_hours(G.gold_hour_zone(_silver(spark, sf_dir, "strict")))


@query
def top_pickup_zones(spark, sf_dir):
    return settle(R.top_pickup_zones(G.pickup_zone_counts(_silver(spark, sf_dir, "spark"))), "avg_fare")


# ---- incremental ---------------------------------------------------------------------


@query
def merge_upsert(spark, sf_dir):
    target, updates = A.merge_inputs(_silver(spark, sf_dir, "dbt"))
    return U.merge_upsert(target, updates, MERGE_KEYS, newest_first(updates))


@query
def incremental_filter(spark, sf_dir):
    silver = _silver(spark, sf_dir, "dbt")
    loaded = silver.filter(F.col("pickup_date") <= A.silver_cutoff(silver))
    return U.incremental_filter(silver, loaded)


@query
def watermark(spark, sf_dir):
    return U.watermark(_silver(spark, sf_dir, "dbt"))


@query
def incremental_run(spark, sf_dir):
    """Raw view -> new rows -> clean -> dedupe -> merge into what is loaded already."""
    view = raw_trips(A.trips_from_events(spark, sf_dir))
    silver = build_silver(view, "dbt")
    loaded = silver.filter(F.col("pickup_date") <= A.silver_cutoff(silver))
    updates = build_silver(U.incremental_filter(view, loaded), "dbt")
    return U.merge_upsert(loaded, updates, MERGE_KEYS, newest_first(updates))


# ---- versions ------------------------------------------------------------------------


@query
def as_of_version(spark, sf_dir):
    return V.as_of_version(A.change_log(spark, sf_dir), A.LOG_KEYS, LOG_VERSION, _log_tiebreak())


@query
def as_of_timestamp(spark, sf_dir):
    return V.as_of_timestamp(A.change_log(spark, sf_dir), A.LOG_KEYS, LOG_MOMENT, _log_tiebreak())


@query
def totals_at_version(spark, sf_dir):
    rows = V.as_of_version(A.change_log(spark, sf_dir), A.LOG_KEYS, LOG_VERSION, _log_tiebreak())
    totals = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("total_amount"))
    return settle(totals, "total_amount")


@query
def version_history(spark, sf_dir):
    return V.version_history(A.change_log(spark, sf_dir))


@query
def rollback_to_version(spark, sf_dir):
    log = A.change_log(spark, sf_dir)
    return V.rollback_to_version(log, A.LOG_KEYS, LOG_VERSION, ROLLBACK_AT, _log_tiebreak())


@query
def expire_versions(spark, sf_dir):
    log = A.change_log(spark, sf_dir)
    return V.expire_versions(log, A.LOG_KEYS, EXPIRE_BEFORE, tiebreak=_log_tiebreak())


# ---- data quality --------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    trips = A.trips_from_events(spark, sf_dir)
    silver = build_silver(trips, "dbt")
    layers = {"raw": trips, "silver": silver, "gold": G.gold_daily_summary(silver)}
    reports = [Q.not_null_report(rows, name).select(F.lit(name).alias("layer"), "*") for name, rows in layers.items()]
    return V.read_together(*reports)


@query
def dq_accepted_values(spark, sf_dir):
    return Q.accepted_values_report(_silver(spark, sf_dir, "dbt"))


@query
def dq_gold_revenue(spark, sf_dir):
    return Q.non_positive_revenue(G.gold_daily_summary(_silver(spark, sf_dir, "dbt")))


@query
def dq_gold_revenue_refunded(spark, sf_dir):
    """The revenue rule where it finds hours: every trip is refunded 60."""
    silver = _silver(spark, sf_dir, "dbt").withColumn("total_amount", F.col("total_amount") - 60)
    return Q.non_positive_revenue(G.gold_daily_summary(silver))


@query
def merge_upsert_incomplete_keys(spark, sf_dir):
    """Updates with and without a complete key, several for each, the latest first."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    key = F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
    target = events.filter("event_id % 3 = 0").select(key.alias("k"), "event_id", "event_type")
    updates = events.filter("event_id % 3 = 1").select(key.alias("k"), "event_id", "event_type")
    return U.merge_upsert(target, updates, ["k"], latest=[F.desc("event_id")])


@query
def dq_silver_duration(spark, sf_dir):
    return Q.non_positive_duration(_silver(spark, sf_dir, "dbt"))


@query
def dq_raw_duration(spark, sf_dir):
    """The duration rule on the uncleaned view, where it finds rows."""
    return Q.non_positive_duration(raw_trips(A.trips_from_events(spark, sf_dir)))


@query
def dq_report_strict(spark, sf_dir):
    return Q.silver_report(_silver(spark, sf_dir, "strict"), "strict")


@query
def dq_report_demo(spark, sf_dir):
    return Q.silver_report(_silver(spark, sf_dir, "demo"), "demo")


@query
def dq_sim(spark, sf_dir):
    return Q.silver_report(_silver(spark, sf_dir, "sim"), "sim")
