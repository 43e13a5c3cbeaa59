"""Gold brought up to date from changed days equals gold built anew; raw layer, manifest and catalog of a run."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import gold as G
from tripstrata.operators import refresh as RF
from tripstrata.operators.history import TableHistory
from tripstrata.plans import medallion as M
from tripstrata.sources.adapters import trips_from_events


def same(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def gold_is_new(spark, root):
    silver = spark.read.parquet(f"{root}/silver/dbt")
    return all(same(spark.read.parquet(f"{root}/gold/dbt/{name}"), build(silver)) for name, build in G.GOLD_TABLES["dbt"].items())


@pytest.fixture
def lake(spark, tmp_path, sf_dir):
    trips, root = trips_from_events(spark, sf_dir), str(tmp_path / "lake")
    M.run_medallion(spark, trips.filter("day(pickup_datetime) not in (9, 10)"), "dbt", root, run_id="first")
    return trips, root


def test_gold_follows_late_and_changed_trips(spark, lake, monkeypatch):
    trips, root = lake
    changed = trips.filter("vendor_id = 1 and day(pickup_datetime) in (3, 9, 17)").withColumn("fare_amount", F.col("fare_amount") + 1)
    late = trips.filter("day(pickup_datetime) = 12").withColumn("pu_location_id", F.col("pu_location_id") + 1000)
    read = []
    real = M.changed_summary

    def spied(stored, silver, touched):
        read.extend(touched)
        return real(stored, silver, touched)

    monkeypatch.setattr(M, "changed_summary", spied)
    monkeypatch.setattr(M, "_rebuild_gold", lambda *_: pytest.fail("gold was rebuilt"))
    M.run_medallion(spark, changed.unionByName(late), "dbt", root, mode="incremental", lookback_days=60)
    assert sorted({day.day for day in read}) == [3, 9, 12, 17]
    assert gold_is_new(spark, root)
    before = dict(spark.read.parquet(f"{root}/gold/dbt/daily_summary").groupBy("pickup_date").agg(F.max("_metadata.file_modification_time")).collect())
    assert M.run_medallion(spark, trips.filter("false"), "dbt", root, mode="incremental").quality  # nothing new
    after = dict(spark.read.parquet(f"{root}/gold/dbt/daily_summary").groupBy("pickup_date").agg(F.max("_metadata.file_modification_time")).collect())
    assert before == after and gold_is_new(spark, root)


def test_days_read_and_days_that_change(spark, lake):
    _, root = lake
    silver, stored = spark.read.parquet(f"{root}/silver/dbt"), spark.read.parquet(f"{root}/gold/dbt/daily_summary")
    day = dt.date(2024, 1, 5)
    rows, days = RF.changed_summary(stored, silver.withColumn("total_amount", F.col("total_amount") * 2), [day])
    assert days == [day]  # the number of trips is the same, so no rolling average moves
    fewer = silver.filter(~((F.col("pickup_date") == day) & (F.col("pickup_hour") == 7)))
    rows, days = RF.changed_summary(stored, fewer, [day])
    assert same(rows, G.gold_daily_summary(fewer).filter(F.col("pickup_date").isin(days)))
    whole = G.gold_daily_summary(fewer)
    assert same(stored.filter(~F.col("pickup_date").isin(days)).unionByName(rows), whole)
    scans = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "silver/dbt" in line]
    assert scans and all(f"(pickup_date = {day})" in re.sub(r"#\d+", "", line).split("PartitionFilters")[1] for line in scans)


def test_gold_that_was_not_finished_is_taken_up_again(spark, lake, monkeypatch):
    trips, root = lake
    with monkeypatch.context() as m:
        m.setattr(M, "_update_gold", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            M.run_medallion(spark, trips, "dbt", root, mode="incremental", lookback_days=60)
    assert not gold_is_new(spark, root)
    M.run_medallion(spark, trips.filter("false"), "dbt", root, mode="incremental")
    assert gold_is_new(spark, root)


def test_a_day_that_is_rolled_back_leaves_gold(spark, lake):
    trips, root = lake
    M.run_medallion(spark, trips, "dbt", root, mode="incremental", lookback_days=60)
    days = lambda: {r[0].day for r in spark.read.parquet(f"{root}/gold/dbt/daily_summary").select("pickup_date").distinct().collect()}
    assert {9, 10} <= days()
    TableHistory(spark, f"{root}/silver/dbt").rollback(1)
    M.run_medallion(spark, trips.filter("false"), "dbt", root, mode="incremental")
    assert not {9, 10} & days() and gold_is_new(spark, root)


def test_raw_layer_manifest_and_catalog(spark, tmp_path, sf_dir):
    trips, root = trips_from_events(spark, sf_dir), str(tmp_path / "lake")
    result = M.run_medallion(spark, trips, "strict", root, run_id="r1", database="lake_names")
    raw = spark.read.parquet(f"{root}/raw/strict")
    assert same(raw.drop("run_id", "outcome"), trips)
    outcomes = dict(raw.groupBy("outcome").count().collect())
    assert outcomes.pop("accepted") == result.record.silver_rows and sum(outcomes.values()) == result.record.rejected_rows
    manifest = {r["layer"]: r["rows"] for r in spark.read.json(f"{root}/manifest/strict/run_id=r1").collect()}
    assert manifest["raw"] == trips.count() and manifest["silver"] == result.record.silver_rows
    for _ in range(2):  # the names follow the next run
        assert spark.table("lake_names.silver_strict").count() == spark.read.parquet(f"{root}/silver/strict").count()
        assert spark.table("lake_names.gold_strict_hourly_zone_summary").count() == spark.read.parquet(f"{root}/gold/strict/hourly_zone_summary").count()
        assert spark.table("lake_names.raw_strict").count() == spark.read.parquet(f"{root}/raw/strict").count()
        M.run_medallion(spark, trips.filter("day(pickup_datetime) < 9"), "strict", root, database="lake_names")
