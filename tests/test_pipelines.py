"""Layered runs and streaming ingest, end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import gold as G
from tripstrata.operators.quality import DataQualityError
from tripstrata.operators.silver import build_silver, newest_per_key
from tripstrata.plans.audit import read_runs
from tripstrata.plans.medallion import run_medallion
from tripstrata.session import shared_folder
from tripstrata.sources import readers as R
from tripstrata.sources import synthetic as S
from tripstrata.sources import writers as W
from tripstrata.sources.adapters import trips_from_events
from tripstrata.streaming.landing import ingest_landing, stream_to_silver


def same(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("profile", ["dbt", "strict", "demo", "spark", "sim"])
def test_full_run(spark, tmp_path, profile):
    trips = S.uniform_trips(spark, 1000, miles=(0.5, 5.0), minutes=(5, 60), seed=3).cache()
    result = run_medallion(spark, trips, profile, str(tmp_path), run_id="r1")
    record = result.record
    assert (record.status, record.raw_rows, record.silver_rows + record.rejected_rows) == ("success", 1000, 1000)
    assert all(line["passed"] for line in result.quality)
    names = {line["rule"] for line in result.quality}
    assert ("revenue_positive" in names) == (profile == "dbt") and (profile == "spark") == (not names)
    silver = build_silver(trips, profile)
    assert same(result.tables["silver"], silver)
    for name, build in G.GOLD_TABLES[profile].items():
        wanted = build(silver)
        numbers = [n for n, kind in wanted.dtypes if kind == "double"]
        near = lambda df: df.withColumns({n: F.round(n, 6) for n in numbers})
        assert same(near(result.tables[name]), near(wanted))
    assert {row["layer"] for row in result.inventory} == {"silver", *(f"gold/{n}" for n in G.GOLD_TABLES[profile])}
    run = read_runs(spark, str(tmp_path / "audit")).first()
    assert (run["flow"], run["run_id"], run["status"], run["rows_processed"]) == (f"medallion_{profile}", "r1", "success", 1000)
    assert run["gold_rows"] == sum(result.tables[n].count() for n in G.GOLD_TABLES[profile])
    assert run["completed_at"] >= run["started_at"]
    assert (tmp_path / "silver" / profile / "pickup_date=2024-01-05").is_dir()


def test_failed_rule_stops_before_publishing(spark, tmp_path, make_trips):
    root = str(tmp_path)
    run_medallion(spark, make_trips({}), "strict", root, run_id="good")
    with pytest.raises(DataQualityError, match="speed_range"):
        run_medallion(spark, make_trips({"trip_distance": 60.0}, {}), "strict", root, run_id="bad")
    assert spark.read.parquet(f"{root}/silver/strict").count() == 1  # still the good run
    runs = {row["run_id"]: row for row in read_runs(spark, f"{root}/audit").collect()}
    assert (runs["good"]["status"], runs["bad"]["status"]) == ("success", "failed")
    assert "speed_range" in runs["bad"]["notes"]
    run_medallion(spark, make_trips({}, {"pu_location_id": 11}), "strict", root)
    assert spark.read.parquet(f"{root}/silver/strict").count() == 2


def test_dry_run_writes_nothing(spark, tmp_path, sf_dir):
    trips = trips_from_events(spark, sf_dir)
    result = run_medallion(spark, trips, "dbt", str(tmp_path / "lake"), write=False)
    assert result.record.raw_rows == 1000 and result.tables["daily_summary"].count() > 0
    assert not (tmp_path / "lake").exists()
    result = run_medallion(spark, trips, "spark", str(tmp_path / "lake"), write=False)
    assert result.record.silver_rows == build_silver(trips, "spark").count()


def test_incremental_runs_add_up(spark, tmp_path, sf_dir):
    root, trips = str(tmp_path), trips_from_events(spark, sf_dir)
    day = F.to_date("pickup_datetime")
    first = run_medallion(spark, trips.filter(day <= dt.date(2024, 1, 15)), "dbt", root, mode="incremental")
    again = run_medallion(spark, trips.filter(day <= dt.date(2024, 1, 15)), "dbt", root, mode="incremental")
    assert again.tables["silver"].count() == first.record.silver_rows
    assert again.record.raw_rows < first.record.raw_rows  # only the newest day was read again
    last = run_medallion(spark, trips, "dbt", root, mode="incremental")
    assert same(last.tables["silver"], newest_per_key(build_silver(trips, "dbt")))
    assert same(last.tables["daily_summary"], G.gold_daily_summary(last.tables["silver"]))
    loaded = last.tables["silver"].count()  # later runs replace the files behind this table
    late = trips.filter(day == dt.date(2024, 1, 3)).withColumn("vendor_id", F.lit(2)).withColumn("pu_location_id", F.lit(7))
    skipped = run_medallion(spark, late, "dbt", root, mode="incremental")
    assert skipped.record.raw_rows == 0  # dated before the watermark
    taken = run_medallion(spark, late, "dbt", root, mode="incremental", lookback_days=40)
    assert taken.tables["silver"].count() > loaded
    with pytest.raises(ValueError, match="incremental"):
        run_medallion(spark, trips, "strict", root, mode="incremental")


def test_landed_files_are_ingested_once(spark, tmp_path, sf_dir):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "checkpoint"))
    trips = trips_from_events(spark, sf_dir)
    early = F.to_date("pickup_datetime") <= dt.date(2024, 1, 10)
    W.land_raw(R.to_raw(trips.filter(early)), landing, dt.date(2024, 1, 10))
    ingest_landing(spark, landing, raw, checkpoint).awaitTermination(120)
    one = spark.read.parquet(raw).count()
    assert one == trips.filter(early).count()
    ingest_landing(spark, landing, raw, checkpoint).awaitTermination(120)
    assert spark.read.parquet(raw).count() == one
    W.land_raw(R.to_raw(trips.filter(~early)), landing, dt.date(2024, 1, 11))
    ingest_landing(spark, landing, raw, checkpoint, files_per_batch=1).awaitTermination(120)
    assert spark.read.parquet(raw).count() == trips.count()


def test_stream_upserts_into_silver(spark, tmp_path, sf_dir):
    landing, silver_path = str(tmp_path / "landing"), str(tmp_path / "silver")
    trips = trips_from_events(spark, sf_dir)
    W.land_raw(R.to_raw(trips), landing, dt.date(2024, 1, 10))
    stream_to_silver(spark, landing, silver_path, str(tmp_path / "c1")).awaitTermination(120)
    wanted = newest_per_key(build_silver(trips, "dbt"))
    stored = lambda: spark.read.parquet(silver_path)
    assert stored().count() == wanted.count()
    # the same files under a new checkpoint are a redelivery: nothing changes
    stream_to_silver(spark, landing, silver_path, str(tmp_path / "c2")).awaitTermination(120)
    assert stored().count() == wanted.count()
    # passenger_count: an empty CSV cell counts as 0
    assert same(stored().drop("passenger_count"), wanted.drop("passenger_count"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).endswith("shared")
    assert shared_folder(spark, "elsewhere").endswith("shared")
