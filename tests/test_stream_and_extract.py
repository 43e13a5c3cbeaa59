"""Stream with gate and quarantine, extracts with stored bookmarks, the default maintenance plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import quality as Q
from tripstrata.operators.clean import split_rejects
from tripstrata.operators.history import TableHistory
from tripstrata.operators.silver import build_silver, newest_per_key
from tripstrata.plans import medallion as M
from tripstrata.plans.audit import read_runs
from tripstrata.plans.maintenance import maintain
from tripstrata.sources import extract as E
from tripstrata.sources import readers as R
from tripstrata.sources import writers as W
from tripstrata.sources.adapters import trips_from_events
from tripstrata.streaming.landing import stream_to_silver, upsert_batch


def test_batches_keep_their_rejects_and_come_twice(spark, tmp_path, sf_dir):
    trips = trips_from_events(spark, sf_dir)
    silver, rejects, audit = (str(tmp_path / n) for n in ("silver", "rejects", "audit"))
    handle = upsert_batch(silver, rejects, audit)
    for _ in range(2):
        handle(trips, 7)
        kept, wanted = spark.read.parquet(rejects), split_rejects(trips, "dbt")[1]
        assert dict(kept.groupBy("reject_reason").count().collect()) == dict(wanted.groupBy("reject_reason").count().collect())
        assert spark.read.parquet(silver).count() == newest_per_key(build_silver(trips, "dbt")).count()
    run = read_runs(spark, audit).first()
    assert (run["status"], run["raw_rows"]) == ("success", 1000)
    assert run["raw_rows"] == run["silver_rows"] + run["rejected_rows"] + run["deduplicated_rows"]


def test_a_batch_that_breaks_a_rule_leaves_silver_alone(spark, tmp_path, make_trips, monkeypatch):
    silver, audit = str(tmp_path / "silver"), str(tmp_path / "audit")
    handle = upsert_batch(silver, audit_path=audit)
    handle(make_trips({}), 0)
    with monkeypatch.context() as m:
        m.setattr(M.Q, "silver_rules", lambda profile: [Q.Rule("cheap", F.col("fare_amount") < 50)])
        with pytest.raises(Q.DataQualityError, match="cheap"):
            handle(make_trips({"fare_amount": 99.0}, {"trip_distance": -1.0}), 1)
    assert [r["fare_amount"] for r in spark.read.parquet(silver).collect()] == [20.0]
    assert sorted(r["status"] for r in read_runs(spark, audit).collect()) == ["failed", "success"]
    handle(make_trips({"fare_amount": 99.0}, {"trip_distance": -1.0}), 1)  # delivered again
    assert [r["fare_amount"] for r in spark.read.parquet(silver).collect()] == [99.0]
    assert spark.read.parquet(f"{silver}__rejects").count() == 1
    handle(make_trips({"trip_distance": -1.0}), 2)  # nothing to merge
    assert spark.read.parquet(f"{silver}__rejects").count() == 2


def test_a_restarted_stream_goes_on(spark, tmp_path, sf_dir):
    landing, silver, rejects, checkpoint = (str(tmp_path / n) for n in ("landing", "silver", "rejects", "checkpoint"))
    trips = trips_from_events(spark, sf_dir)
    early = F.to_date("pickup_datetime") <= dt.date(2024, 1, 10)
    for day, part in ((10, trips.filter(early)), (11, trips.filter(~early))):
        W.land_raw(R.to_raw(part), landing, dt.date(2024, 1, day))
        stream_to_silver(spark, landing, silver, checkpoint, rejects_path=rejects).awaitTermination(120)
    assert spark.read.parquet(silver).count() == newest_per_key(build_silver(trips, "dbt")).count()
    kept = spark.read.parquet(rejects)
    assert kept.count() == split_rejects(trips, "dbt")[1].count() and kept.select("stream").distinct().count() == 1


def stamped(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, d), v) for k, d, v in rows], "k int, at timestamp_ntz, v string")


def taken(frame):
    return sorted((r["k"], r["at"].day, r["v"]) for r in frame.collect())


def test_extracts_neither_lose_nor_repeat_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "extracts")
    rows = [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]
    assert E.bookmark(spark, path, "at") is None
    assert taken(E.extract_new(stamped(spark, rows), path, ["k"], "at")) == rows
    assert E.bookmark(spark, path, "at") == dt.datetime(2024, 1, 3)
    rows += [(4, 3, "late, same stamp"), (2, 4, "b2"), (5, 2, "dated before the bookmark")]
    with monkeypatch.context() as m:
        m.setattr(E, "write_parquet", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            E.extract_new(stamped(spark, rows), path, ["k"], "at")
    assert E.bookmark(spark, path, "at") == dt.datetime(2024, 1, 3)
    assert taken(E.extract_new(stamped(spark, rows), path, ["k"], "at")) == [(2, 4, "b2"), (4, 3, "late, same stamp")]
    assert taken(E.extract_new(stamped(spark, rows), path, ["k"], "at")) == []
    assert taken(E.extract_new(stamped(spark, rows + [(2, 4, "b3, same stamp")]), path, ["k"], "at", [F.desc("v")])) == [(2, 4, "b3, same stamp")]
    assert E.last_extract(spark, path) == 3  # an extract without rows leaves its number to the next
    # files without the mark of a finished write, as a stopped job can leave them, do not count
    W.write_parquet(stamped(spark, [(9, 9, "half")]), f"{path}/_extract=4")
    (tmp_path / "extracts/_extract=4/_SUCCESS").unlink()
    assert E.bookmark(spark, path, "at") == dt.datetime(2024, 1, 4) and E.last_extract(spark, path) == 3
    assert taken(E.extract_new(stamped(spark, rows + [(6, 5, "new")]), path, ["k"], "at")) == [(6, 5, "new")]
    assert E.last_extract(spark, path) == 4


def test_default_maintenance(spark, tmp_path, sf_dir):
    trips, root = trips_from_events(spark, sf_dir).filter("day(pickup_datetime) < 4"), str(tmp_path / "lake")
    for fare in range(5):
        M.run_medallion(spark, trips.withColumn("tip_amount", F.col("tip_amount") + fare), "dbt", root, mode="incremental", lookback_days=9)
    history = TableHistory(spark, f"{root}/silver/dbt")
    rows = spark.read.parquet(f"{root}/silver/dbt").count()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert {r["status"] for r in maintain(spark, root, now=now).collect()} == {"success"}
    assert history.newest() == 5 and history.commits().count() == 5  # younger than a week
    assert {r["status"] for r in maintain(spark, root, now=now + dt.timedelta(days=8)).collect()} == {"success"}
    assert history.commits().count() == 3 and history.floor() == 3
    assert spark.read.parquet(f"{root}/silver/dbt").count() == rows == history.as_of(5).count()
