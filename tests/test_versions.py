"""Change-log queries against a plain replay of the log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import stored as ST
from tripstrata.operators import versions as V
from tripstrata.sources.adapters import LOG_KEYS, change_log

ORDER = lambda: [F.desc("event_id")]


@pytest.fixture
def log(spark, sf_dir):
    return change_log(spark, sf_dir)


def replay(log, upto):
    state = {}
    for row in sorted(log.collect(), key=lambda r: (r["_version"], r["event_id"])):
        if row["_version"] <= upto:
            if row["_op"] == "D":
                state.pop(row["trip_key"], None)
            else:
                state[row["trip_key"]] = row["event_id"]
    return state


def live(frame):
    return {row["trip_key"]: row["event_id"] for row in frame.collect()}


@pytest.mark.parametrize("version", [0, 1, 4, 10, 99])
def test_as_of_version(log, version):
    assert live(V.as_of_version(log, LOG_KEYS, version, ORDER())) == replay(log, version)


def test_as_of_timestamp(log):
    moment = dt.datetime(2024, 2, 6)  # exactly the commit of version 5
    assert live(V.as_of_timestamp(log, LOG_KEYS, moment, ORDER())) == replay(log, 5)
    assert live(V.as_of_timestamp(log, LOG_KEYS, "2024-02-05 23:59:59", ORDER())) == replay(log, 4)


def test_below_the_floor_is_an_error(spark, log, tmp_path):
    expired = V.expire_versions(log, LOG_KEYS, "2024-02-06", 1, ORDER())
    floor = expired.agg(F.min("_version"), F.min("_committed_at")).first()
    assert floor[0] > 1
    path = str(tmp_path / "log")  # stored, partition pruning leaves no file to read
    ST.append_to_log(expired, path)
    for rows in (expired, ST.read_change_log(spark, path)):
        with pytest.raises(Exception, match="the log begins at"):
            V.as_of_version(rows, LOG_KEYS, floor[0] - 1, ORDER()).collect()
        with pytest.raises(Exception, match="the log begins at"):
            V.as_of_timestamp(rows, LOG_KEYS, floor[1] - dt.timedelta(seconds=1), ORDER()).collect()
        assert live(V.as_of_version(rows, LOG_KEYS, floor[0], ORDER())) == replay(log, floor[0])
    assert V.as_of_version(log.limit(0), LOG_KEYS, 3, ORDER()).collect() == []


def test_history(log):
    history = {row["_version"]: row for row in V.version_history(log).collect()}
    assert sorted(history) == list(range(1, 11))
    assert sum(row["changes"] for row in history.values()) == log.count()
    assert all(row["changes"] == row["upserts"] + row["deletes"] for row in history.values())


@pytest.mark.parametrize("version", [3, 6, 10])
def test_rollback_restores_the_version(log, version):
    undo = V.rollback_to_version(log, LOG_KEYS, version, "2024-02-12 00:00:00", ORDER())
    assert undo.columns == log.columns
    after = log.unionByName(undo)
    wanted = replay(log, version)
    assert {row["trip_key"]: row["event_id"] for row in V.current_rows(after, LOG_KEYS, ORDER()).collect()} == wanted
    changes = undo.groupBy("trip_key").count().filter("count > 1").count()
    assert changes == 0
    if version == 10:
        assert undo.count() == 0


def test_expiry_keeps_reads_of_kept_versions(log):
    kept = V.expire_versions(log, LOG_KEYS, "2024-02-07 00:00:00", retain_last=3, tiebreak=ORDER())
    versions = sorted(row[0] for row in kept.select("_version").distinct().collect())
    assert versions == [5, 6, 7, 8, 9, 10]  # 5 is the base image
    for version in (5, 6, 8, 10):
        assert live(V.as_of_version(kept, LOG_KEYS, version, ORDER())) == replay(log, version)


def test_expiry_always_keeps_the_newest(log):
    kept = V.expire_versions(log, LOG_KEYS, "2030-01-01 00:00:00", retain_last=3, tiebreak=ORDER())
    assert sorted(row[0] for row in kept.select("_version").distinct().collect()) == [7, 8, 9, 10]
    untouched = V.expire_versions(log, LOG_KEYS, "2020-01-01 00:00:00", retain_last=3, tiebreak=ORDER())
    assert untouched.count() == log.count()
    assert V.expire_versions(log.filter("false"), LOG_KEYS, "2030-01-01 00:00:00", tiebreak=ORDER()).count() == 0


def test_stored_log(spark, log, tmp_path):
    path = str(tmp_path / "log")
    ST.append_to_log(log, path)
    stored = ST.read_change_log(spark, path)
    assert live(V.as_of_version(stored, LOG_KEYS, 4, ORDER())) == replay(log, 4)
    plan = V.as_of_version(stored, LOG_KEYS, 4, ORDER())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_version" in plan
    extra = V.append_changes(stored.filter("_version = 1").drop(*V.META), 11, "2024-02-12 00:00:00")
    ST.append_to_log(extra, path)
    wanted = replay(ST.read_change_log(spark, path), 11)
    ST.expire_stored_log(spark, path, LOG_KEYS, "2030-01-01 00:00:00", tiebreak=ORDER())
    again = ST.read_change_log(spark, path)
    assert live(V.current_rows(again, LOG_KEYS, ORDER())) == wanted
    assert sorted(row[0] for row in again.select("_version").distinct().collect()) == [8, 9, 10, 11]


def test_interrupted_publish_is_recovered(spark, log, tmp_path):
    from tripstrata.sources import files

    path, stage = str(tmp_path / "t"), str(tmp_path / "t__staged")
    log.write.parquet(path)
    files.rename(spark, path, path + "__previous")
    files.recover(spark, stage, path)  # nothing staged: the old folder comes back
    assert spark.read.parquet(path).count() == log.count()
    log.limit(5).write.parquet(stage)
    files.rename(spark, path, path + "__previous")
    files.recover(spark, stage, path)  # stage complete: it takes the place
    assert spark.read.parquet(path).count() == 5
    assert not files.exists(spark, path + "__previous")


def test_tables_of_different_width(spark):
    both = V.read_together(spark.sql("select 1 a"), spark.sql("select 2 a, 3 b"))
    assert sorted(map(str, both.collect())) == ["Row(a=1, b=None)", "Row(a=2, b=3)"]
