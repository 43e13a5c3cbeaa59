"""Reading, rolling back and expiring versions of a stored table, and commits that stop half-way."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import history as H
from tripstrata.operators import stored as S
from tripstrata.plans.medallion import run_medallion
from tripstrata.sources import files
from tripstrata.sources.adapters import trips_from_events
from tripstrata.sources.writers import write_parquet

SCHEMA = "k int, v double, pickup_date date"
DAY = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, DAY + dt.timedelta(d)) for k, v, d in rows], SCHEMA)


def bag(rows):
    return Counter(map(tuple, rows.select(*sorted(rows.columns)).collect()))


def moment(n):
    return dt.datetime(2024, 2, n)


STATES = [
    [(1, 1.0, 0), (2, 2.0, 0), (3, 3.0, 1), (None, 4.0, 1), (None, 4.0, 1)],
    [(1, 1.5, 0), (2, 2.0, 0), (3, 3.0, 1), (None, 4.0, 1)],
    [(3, 3.0, 1), (None, None, 2), (9, 9.0, 3)],
    [(3, 3.0, 1)] * 4,
]


@pytest.fixture
def table(spark, tmp_path):
    history = H.TableHistory(spark, str(tmp_path / "t"))
    for n, rows in enumerate(STATES, 1):
        stage = str(tmp_path / "stage")
        write_parquet(frame(spark, rows), stage, partition_by=["pickup_date"])
        assert history.commit(stage, f"state {n}", replace=True, moment=moment(n)) == n
    return history


def test_every_version_can_be_read(spark, table):
    for n, rows in enumerate(STATES, 1):
        assert bag(table.as_of(n)) == bag(frame(spark, rows))
        assert bag(table.as_of_time(moment(n) + dt.timedelta(hours=1))) == bag(frame(spark, rows))
    assert bag(spark.read.parquet(table.path)) == bag(frame(spark, STATES[-1]))
    assert [(r["_version"], r["added"], r["removed"]) for r in table.commits().orderBy("_version").collect()] == [(1, 5, 0), (2, 1, 2), (3, 2, 3), (4, 3, 2)]


def test_versions_that_are_not_there_are_errors(table):
    for version in (0, 5):
        with pytest.raises(ValueError, match="versions 1 to 4 are kept"):
            table.as_of(version)
    with pytest.raises(ValueError, match="oldest kept version is younger"):
        table.as_of_time(dt.datetime(2024, 1, 31))


def test_expiry_keeps_reads_and_moves_the_floor(spark, table):
    assert table.expire(moment(3), retain_last=1) == 3
    for n in (3, 4):
        assert bag(table.as_of(n)) == bag(frame(spark, STATES[n - 1]))
    for version in (1, 2):
        with pytest.raises(ValueError, match="versions 3 to 4 are kept"):
            table.as_of(version)
    with pytest.raises(ValueError):
        table.as_of_time(moment(2))
    assert [r[0] for r in table.commits().select("_version").orderBy("_version").collect()] == [3, 4]
    assert table.expire(moment(9), retain_last=2) == 3  # the two newest stay
    assert table.expire(moment(9), retain_last=1) == 4
    assert bag(table.as_of(4)) == bag(frame(spark, STATES[3]))
    with pytest.raises(ValueError):
        table.expire(moment(9), retain_last=0)


@pytest.mark.parametrize("version", [1, 2, 3])
def test_rollback_is_a_new_version(spark, table, version):
    assert table.rollback(version, moment(9)) == 5
    assert bag(spark.read.parquet(table.path)) == bag(frame(spark, STATES[version - 1]))
    assert bag(table.as_of(5)) == bag(frame(spark, STATES[version - 1]))
    assert bag(table.as_of(4)) == bag(frame(spark, STATES[3]))
    assert table.operations()[-1] == f"rollback to {version}"


def test_rollback_after_expiry(spark, table):
    table.expire(moment(3), retain_last=1)
    table.rollback(3, moment(9))
    assert bag(spark.read.parquet(table.path)) == bag(frame(spark, STATES[2]))
    assert not files.exists(spark, f"{table.path}/pickup_date=2024-01-01")


def test_a_table_that_was_there_before_its_history(spark, tmp_path):
    path = str(tmp_path / "t")
    S.merge_into_path(spark, path, frame(spark, STATES[0]), ["k"])
    history = H.TableHistory(spark, path)
    S.merge_into_path(spark, path, frame(spark, [(3, 7.0, 1)]), ["k"], history=True)
    S.merge_into_path(spark, path, frame(spark, [(3, 8.0, 1)]), ["k"])
    assert history.operations() == ["import", "merge", "merge"]
    assert bag(history.as_of(1)) == bag(frame(spark, STATES[0]))
    assert bag(history.as_of(3)) == bag(spark.read.parquet(path))


@pytest.mark.parametrize("step", ["differences", "commit row", "publish", "note"])
@pytest.mark.parametrize("replace", [True, False])
def test_a_commit_that_stops_is_finished(spark, tmp_path, monkeypatch, step, replace):
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    history = H.TableHistory(spark, path)
    write_parquet(frame(spark, STATES[0]), stage, partition_by=["pickup_date"])
    history.commit(stage, "one", replace=True)
    new = [(1, 9.0, 0)]
    want = bag(frame(spark, new if replace else new + [r for r in STATES[0] if r[2]]))
    write_parquet(frame(spark, new), stage, partition_by=["pickup_date"])

    def stop(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "differences":
            m.setattr(H, "differences", stop)
        elif step == "commit row":
            real = H.write_parquet
            m.setattr(H, "write_parquet", lambda *a, **b: (real(*a, **b), stop()))
        elif step == "publish":
            m.setattr(H.TableHistory, "_publish", stop)
        else:
            m.setattr(H.files, "delete", stop)
        with pytest.raises(RuntimeError):
            history.commit(stage, "two", replace=replace)
    if step in ("differences", "commit row", "publish"):
        assert bag(spark.read.parquet(path)) == bag(frame(spark, STATES[0]))
    assert history.finish()
    assert bag(spark.read.parquet(path)) == want == bag(history.as_of(2))
    assert history.operations() == ["one", "two"] and not history.finish()
    assert bag(history.as_of(1)) == bag(frame(spark, STATES[0]))


def test_runs_leave_a_history_of_silver(spark, tmp_path, sf_dir):
    """As of each run equals silver as it was after that run."""
    trips, root = trips_from_events(spark, sf_dir), str(tmp_path / "lake")
    half = trips.filter("pickup_datetime < timestamp_ntz'2024-01-16 00:00:00'")
    states = []
    for rows, mode in ((half, "full"), (trips, "incremental"), (trips.withColumn("tip_amount", F.col("tip_amount") + 1), "incremental")):
        run_medallion(spark, rows, "dbt", root, mode=mode)
        states.append(bag(spark.read.parquet(f"{root}/silver/dbt")))
    history = H.TableHistory(spark, f"{root}/silver/dbt")
    assert history.operations() == ["rebuild", "merge", "merge"]
    for version, state in enumerate(states, 1):
        assert bag(history.as_of(version)) == state
    last = history.changes(2)
    assert last.filter("_delta > 0").count() == last.filter("_delta < 0").count() > 0
    history.rollback(1)
    assert bag(spark.read.parquet(f"{root}/silver/dbt")) == states[0]
