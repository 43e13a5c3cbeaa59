"""Rule boundaries, reject accounting and features, by hand-computed rows."""

import pytest
from pyspark.sql import functions as F

from tripstrata import functions as X
from tripstrata.operators import gold as G
from tripstrata.operators import quality as Q
from tripstrata.operators.clean import clean, reject_summary, split_rejects, with_reject_reason
from tripstrata.operators.silver import build_silver, raw_trips, register_raw_view
from tripstrata.profiles import PROFILES, get_profile
from tripstrata.schemas import SILVER_COLUMNS

PICKUP = "2024-01-10 12:00:00"


def ends(minutes):
    import datetime as dt

    return dt.datetime.fromisoformat(PICKUP) + dt.timedelta(minutes=minutes)


# case, changed fields, profiles that keep the row
CASES = [
    ("plain", {}, "dbt strict demo spark sim"),
    ("distance 0.05", {"trip_distance": 0.05}, "strict demo spark sim"),
    ("distance 0.1", {"trip_distance": 0.1}, "dbt strict demo spark sim"),
    ("distance 100", {"trip_distance": 100.0, "dropoff_datetime": ends(100)}, "dbt strict demo spark sim"),
    ("distance 100.01", {"trip_distance": 100.01, "dropoff_datetime": ends(100)}, "strict demo spark sim"),
    ("distance 200", {"trip_distance": 200.0, "dropoff_datetime": ends(150)}, "strict demo spark sim"),
    ("distance 200.01", {"trip_distance": 200.01, "dropoff_datetime": ends(150)}, "spark sim"),
    ("distance 0", {"trip_distance": 0.0}, ""),
    ("distance missing", {"trip_distance": None}, ""),
    ("fare 0.99", {"fare_amount": 0.99}, "strict demo spark sim"),
    ("fare 1", {"fare_amount": 1.0}, "dbt strict demo spark sim"),
    ("fare 500", {"fare_amount": 500.0}, "dbt strict demo spark sim"),
    ("fare 500.01", {"fare_amount": 500.01}, "spark sim"),
    ("fare missing", {"fare_amount": None}, ""),
    ("total 0", {"total_amount": 0.0}, ""),
    ("duration 0.5", {"dropoff_datetime": ends(0.5), "trip_distance": 0.5}, "strict demo spark sim"),
    ("duration 240", {"dropoff_datetime": ends(240)}, "dbt strict demo spark sim"),
    ("duration 240.5", {"dropoff_datetime": ends(240.5)}, "strict demo spark sim"),
    ("duration 300", {"dropoff_datetime": ends(300)}, "strict demo sim"),
    ("duration 300.5", {"dropoff_datetime": ends(300.5)}, "sim"),
    ("dropoff at pickup", {"dropoff_datetime": PICKUP}, ""),
    ("dropoff before pickup", {"dropoff_datetime": ends(-5)}, ""),
    ("passengers 0", {"passenger_count": 0}, "dbt demo spark sim"),
    ("passengers 9", {"passenger_count": 9}, "dbt strict demo spark sim"),
    ("passengers 10", {"passenger_count": 10}, "dbt demo spark sim"),
    ("passengers missing", {"passenger_count": None}, "dbt demo spark sim"),
    ("tip -1", {"tip_amount": -1.0}, "dbt demo spark sim"),
    ("tip missing", {"tip_amount": None}, "dbt demo spark"),
    ("speed 120", {"trip_distance": 60.0}, "dbt strict demo spark sim"),
    ("speed 120.01", {"trip_distance": 60.005}, "dbt demo spark sim"),
    ("no pickup", {"pickup_datetime": None}, ""),
    ("no dropoff", {"dropoff_datetime": None}, ""),
]


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_boundaries(make_trips, profile):
    """The flag column carries the case name through cleaning."""
    trips = make_trips(*[{**change, "store_and_fwd_flag": case} for case, change, _ in CASES])
    expected = {case for case, _, keepers in CASES if profile in keepers.split()}
    kept = {row[0] for row in clean(trips, profile).select("store_and_fwd_flag").collect()}
    assert kept == expected
    accepted, rejected = split_rejects(trips, profile)
    assert {row[0] for row in accepted.select("store_and_fwd_flag").collect()} == expected
    assert rejected.count() == len(CASES) - len(expected)


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_rejects_and_silver_add_up_to_raw(spark, sf_dir, profile):
    from tripstrata.sources.adapters import trips_from_events

    trips = trips_from_events(spark, sf_dir)
    rows = {row["reject_reason"]: row["rows"] for row in reject_summary(trips, profile).collect()}
    assert sum(rows.values()) == trips.count()
    silver = build_silver(trips, profile)
    assert rows["accepted"] == silver.count()
    assert silver.columns == SILVER_COLUMNS[profile]


def test_view_rows_are_cleaned_like_trips(make_trips):
    """Through the typed view the duration is a given column; the same rows survive."""
    trips = make_trips(*[{**change, "do_location_id": i} for i, (_, change, _) in enumerate(CASES)])
    direct = {row[0] for row in build_silver(trips, "dbt").select("do_location_id").collect()}
    viewed = {row[0] for row in build_silver(raw_trips(trips), "dbt").select("do_location_id").collect()}
    assert direct == viewed == {i for i, case in enumerate(CASES) if "dbt" in case[2]}


def test_first_failing_rule_is_named(make_trips):
    trips = make_trips({"trip_distance": 0.0, "fare_amount": 0.0}, {"fare_amount": 900.0}, {})
    reasons = [row[0] for row in with_reject_reason(trips, "strict").select("reject_reason").collect()]
    assert reasons == ["distance", "fare", None]


def test_profile_thresholds_can_be_replaced(make_trips):
    from dataclasses import replace

    base = get_profile("dbt")
    wide = replace(base, gates=tuple(replace(g, high=300.0) if g.reason == "distance" else g for g in base.gates))
    trips = make_trips({"trip_distance": 250.0})
    assert clean(trips, "dbt").count() == 0
    assert clean(trips, wide).count() == 1
    with pytest.raises(ValueError, match="unknown profile"):
        get_profile("nope")


def test_day_parts_and_weekdays(spark):
    hours = spark.range(24).select("id", X.time_of_day("id").alias("part")).collect()
    parts = {row["id"]: row["part"] for row in hours}
    edges = {5: "overnight", 6: "morning_rush", 9: "morning_rush", 10: "midday", 15: "midday", 16: "evening_rush",
             19: "evening_rush", 20: "evening", 22: "evening", 23: "overnight"}
    assert {hour: parts[hour] for hour in edges} == edges
    days = spark.sql("select date'2024-01-06' d union all select date'2024-01-07'")
    for sunday, saturday_number in ((1, 7), (0, 6), (7, 6)):
        dow = X.day_of_week("d", sunday)
        assert sorted(row[0] for row in days.select(dow).collect()) == sorted([saturday_number, sunday])
    named = days.select(X.day_name(F.dayofweek("d")).alias("n"), X.is_weekend(F.dayofweek("d")).alias("w")).collect()
    assert {row["n"] for row in named} == {"Saturday", "Sunday"} and all(row["w"] for row in named)
    odd = spark.sql("select cast(null as int) h, 99 d").select(X.time_of_day("h"), X.day_name("d")).first()
    assert tuple(odd) == ("overnight", None)


def test_rounding_and_division(spark):
    row = spark.sql("select 1.005d a, 0.285d*100 b, 2.5d c, 0.0d z, cast(null as double) n, 'NaN' t, '1.0' u, '12abc' w")
    got = row.select(
        X.round_half_up("a", 2), X.round_half_up("b", 1), X.round_half_up(-F.col("c"), 0), X.safe_divide("c", "z"),
        X.safe_divide("c", "n", -1), X.safe_divide("n", "c"), X.clean_number("t", "double"), X.clean_number("u", "int"),
        X.clean_number("w", "double"),
    ).first()
    assert tuple(got) == (1.01, 28.5, -3.0, 0.0, -1.0, None, None, 1, None)


def test_labels_and_small_classes(spark):
    codes = spark.sql("select explode(array(1,2,3,4,5,6,0,-1,cast(null as int))) c")
    labels = [row[0] for row in codes.select(X.payment_label("c")).collect()]
    assert labels == ["credit_card", "cash", "no_charge", "dispute"] + ["unknown"] * 5
    miles = spark.sql("select explode(array(0.99d,1d,4.99d,5d,14.99d,15d,cast(null as double))) m")
    classes = [row[0] for row in miles.select(X.distance_class("m")).collect()]
    assert classes == ["short", "medium", "medium", "long", "long", "very_long", "very_long"]
    hours = spark.sql("select explode(array(7,8,18,19,cast(null as int))) h")
    assert [row[0] for row in hours.select(X.business_hours("h")).collect()] == [False, True, True, False, False]


def test_missing_tip_is_not_tipped(make_trips):
    row = build_silver(make_trips({"tip_amount": None}), "dbt").first()
    assert row["was_tipped"] is False and row["tip_pct"] is None
    demo = build_silver(make_trips({"tip_amount": None, "passenger_count": None}), "demo").first()
    assert (demo["tip_amount"], demo["passenger_count"], demo["tip_pct"]) == (0.0, 0, 0.0)


def test_strict_features(make_trips):
    row = build_silver(make_trips({"pu_location_id": 132, "trip_distance": 10.0}), "strict").first()
    assert (row["is_airport_trip"], row["is_long_trip"], row["avg_speed_mph"]) == (True, True, 20.0)
    assert (row["tip_pct"], row["fare_per_mile"], row["revenue_per_minute"]) == (20.0, 2.0, 0.84)
    assert (row["pickup_year"], row["pickup_month"], row["pickup_day"], row["day_of_week"]) == (2024, 1, 10, 3)


def test_speed_of_exactly_120_passes_cleaning_and_fails_the_report(make_trips):
    silver = build_silver(make_trips({"trip_distance": 60.0}), "strict")
    assert silver.first()["avg_speed_mph"] == 120.0
    with pytest.raises(Q.DataQualityError, match="speed_range"):
        Q.enforce(Q.silver_report(silver, "strict"))


def test_reports_on_empty_input(make_trips):
    nothing = make_trips({}).filter("false")
    for profile in ("strict", "demo", "dbt"):
        rows = Q.enforce(Q.silver_report(build_silver(nothing, profile), profile))
        assert all(row["checked"] == 0 for row in rows)
    with pytest.raises(Q.DataQualityError, match="not_empty"):
        Q.enforce(Q.silver_report(build_silver(nothing, "sim"), "sim"))
    with pytest.raises(Q.DataQualityError, match="empty layer: b"):
        Q.require_rows(a=make_trips({}), b=nothing)


def test_gold_rules_find_what_they_should(make_trips):
    gold = G.gold_daily_summary(build_silver(make_trips({}), "dbt"))
    Q.enforce(Q.report(gold, Q.gold_rules("dbt")))
    broken = gold.withColumns({"total_revenue": F.lit(0.0), "day_name": F.lit(None).cast("string")})
    failed = {row["rule"] for row in Q.report(broken, Q.gold_rules("dbt")).collect() if not row["passed"]}
    assert failed == {"revenue_positive", "not_null:day_name"}
    assert Q.non_positive_revenue(broken).count() == 1 and Q.non_positive_revenue(gold).count() == 0


def test_accepted_values_leave_null_to_other_rules(make_trips):
    silver = build_silver(make_trips({"payment_type": 9}, {"payment_type": None}, {"vendor_id": 3}), "dbt")
    failed = {row["rule"]: row["failed"] for row in Q.accepted_values_report(silver).collect()}
    assert failed == {
        "accepted_values:vendor_id": 1, "accepted_values:payment_type": 1,
        "accepted_values:payment_type_label": 0, "accepted_values:time_of_day": 0,
    }


def test_preview(make_trips):
    from tripstrata.operators.ranking import preview

    assert preview(make_trips({}, {}, {}), 2).count() == 2


def test_register_view(spark, make_trips):
    register_raw_view(make_trips({}), "v_raw")
    assert spark.sql("select count(tpep_pickup_datetime) from v_raw").first()[0] == 1


def test_rank_ties_and_rolling_gap(spark):
    """Ties go to the earlier hour; a missing day stretches the rolling window."""
    from tripstrata.operators.ranking import rank_hours

    rows = [("2024-01-01", 5, 10, 1.0), ("2024-01-01", 6, 10, 1.0), ("2024-01-01", 7, 11, 0.5)]
    rows += [(f"2024-01-{day:02d}", 5, day, 1.0) for day in (2, 3, 4, 5, 6, 9, 10)]
    hourly = spark.createDataFrame(rows, "d string, pickup_hour int, trip_count bigint, total_revenue double")
    ranked = rank_hours(hourly.withColumn("pickup_date", F.to_date("d")))
    got = {(str(r["pickup_date"]), r["pickup_hour"]): r for r in ranked.collect()}
    first = [got["2024-01-01", h] for h in (5, 6, 7)]
    assert [r["hour_rank_by_volume"] for r in first] == [2, 3, 1]
    assert [r["hour_rank_by_revenue"] for r in first] == [1, 2, 3]
    assert all(r["is_peak_hour"] for r in first)
    assert got["2024-01-10", 5]["rolling_7d_avg_trips"] == round((2 + 3 + 4 + 5 + 6 + 9 + 10) / 7, 1)


def test_gold_trips_add_up_to_silver(spark, sf_dir):
    from tripstrata.sources.adapters import trips_from_events

    trips = trips_from_events(spark, sf_dir)
    for profile, tables in G.GOLD_TABLES.items():
        silver = build_silver(trips, profile)
        for build in tables.values():
            assert build(silver).agg(F.sum("trip_count")).first()[0] == silver.count()
