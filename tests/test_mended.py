"""Cases in which rows were once lost, repeated or put under wrong names."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripstrata import functions as X
from tripstrata.operators import stored as ST
from tripstrata.operators import upsert as U
from tripstrata.operators import versions as V
from tripstrata.operators.clean import acceptance_rules, clean, split_rejects
from tripstrata.operators.silver import build_silver
from tripstrata.plans import medallion as M
from tripstrata.plans.audit import read_runs
from tripstrata.profiles import Gate, Profile, above_upto, between, present
from tripstrata.sources import readers as R
from tripstrata.sources import writers as W
from tripstrata.streaming.landing import ingest_landing


def updates(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, j int, v int")


def test_incomplete_keys_stay_apart_when_updates_are_deduped(spark):
    target = updates(spark, ("a", 1, 0))
    rows = updates(spark, (None, 1, 1), (None, 1, 2), ("a", None, 3), ("a", None, 4), ("a", 1, 5), ("a", 1, 6))
    merged = U.merge_upsert(target, rows, ["k", "j"], latest=[F.desc("v")])
    assert sorted(r["v"] for r in merged.collect()) == [1, 2, 3, 4, 6]


def rows_of(spark, root):
    return spark.read.parquet(f"{root}/silver/dbt")


def test_both_modes_store_the_same_first_load(spark, make_trips, tmp_path):
    trips = make_trips({}, {"pu_location_id": None}, {"pu_location_id": None}, {"vendor_id": 2}, {"vendor_id": 2, "fare_amount": 30.0}, {"trip_distance": -1.0})
    stored = []
    for mode in ("full", "incremental"):
        root = str(tmp_path / mode)
        record = M.run_medallion(spark, trips, "dbt", root, mode=mode).record
        assert (record.raw_rows, record.silver_rows, record.rejected_rows, record.deduplicated_rows) == (6, 4, 1, 1)
        stored.append(sorted(map(str, rows_of(spark, root).collect())))
    assert stored[0] == stored[1]
    rows = spark.read.parquet(f"{tmp_path}/full/audit")
    assert sorted(r["status"] for r in rows.collect()) == ["running", "success"]
    assert [r["status"] for r in read_runs(spark, f"{tmp_path}/full/audit").collect()] == ["success"]
    rows.filter("status = 'running'").write.parquet(f"{tmp_path}/died")
    assert [r["status"] for r in read_runs(spark, f"{tmp_path}/died").collect()] == ["running"]


@pytest.fixture
def interrupted(spark, make_trips, tmp_path, monkeypatch):
    """A table, and a merge of a dearer trip that stopped between stage and publishing."""
    root = str(tmp_path / "lake")
    trips = make_trips(*[{"pu_location_id": i} for i in range(1, 6)])
    M.run_medallion(spark, trips, "dbt", root)
    dearer = make_trips({"pu_location_id": 1, "fare_amount": 99.0})
    true_finish = ST.finish_merge

    def stop(*args):
        if ST.files.exists(spark, f"{root}/silver/dbt__merging"):
            raise RuntimeError("lost")
        return true_finish(*args)

    with monkeypatch.context() as patch:
        patch.setattr(ST, "finish_merge", stop)
        with pytest.raises(RuntimeError, match="lost"):
            M.run_medallion(spark, dearer, "dbt", root, mode="incremental")
    assert ST.files.is_complete(spark, f"{root}/silver/dbt__merging")
    return root, trips, dearer


def test_incremental_run_goes_on_after_an_interrupted_merge(spark, interrupted):
    root, _, dearer = interrupted
    M.run_medallion(spark, dearer, "dbt", root, mode="incremental")
    assert sorted(r["fare_amount"] for r in rows_of(spark, root).collect()) == [20.0] * 4 + [99.0]


def test_an_old_stage_never_overwrites_a_rebuild(spark, interrupted, make_trips):
    root, trips, _ = interrupted
    M.run_medallion(spark, trips.withColumn("fare_amount", F.lit(50.0)), "dbt", root)
    M.run_medallion(spark, trips.filter("false"), "dbt", root, mode="incremental")
    assert {r["fare_amount"] for r in rows_of(spark, root).collect()} == {50.0}


def test_a_failing_gold_rule_leaves_the_old_table(spark, make_trips, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    M.run_medallion(spark, make_trips({}), "dbt", root)
    monkeypatch.setattr(M.Q, "gold_rules", lambda profile: [M.Q.Rule("few", F.col("trip_count") < 2)])
    with pytest.raises(M.Q.DataQualityError, match="few"):
        M.run_medallion(spark, make_trips({}, {"vendor_id": 2}), "dbt", root)
    gold = spark.read.parquet(f"{root}/gold/dbt/daily_summary")
    assert [r["trip_count"] for r in gold.collect()] == [1]
    assert list((tmp_path / "lake/gold/dbt/daily_summary").glob("pickup_date=*"))


bound = st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 30.0, 60.0]))
gates = st.lists(
    st.one_of(
        st.sampled_from([present("pickup_datetime"), present("dropoff_datetime"), present("fare_amount"), above_upto("total", "total_amount", 0.0), between("distance", "trip_distance", 0.1, 100.0)]),
        st.builds(lambda lo, hi, a, b: Gate("duration", "trip_duration_minutes", lo, hi, a, b), bound, bound, st.booleans(), st.booleans()),
    ),
    max_size=4,
    unique_by=lambda g: g.reason,
)


@pytest.fixture(scope="module")
def odd_trips(spark, make_trips):
    start = dt.datetime(2024, 1, 10, 12)
    times = [(start, start + dt.timedelta(minutes=m)) for m in (-5, 0, 0.4, 30, 60, 61)] + [(None, start), (start, None), (None, None)]
    rows = [{"pickup_datetime": a, "dropoff_datetime": b, "vendor_id": i} for i, (a, b) in enumerate(times)]
    return make_trips(*rows, {"vendor_id": 20, "fare_amount": None}, {"vendor_id": 21, "trip_distance": 0.0}).cache()


@given(gates, st.booleans(), st.sampled_from([None, 20.0]))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_clean_is_the_accepted_side_of_any_profile(odd_trips, some, ordered, speed):
    profile = Profile("any", tuple(some), ordered_times=ordered, max_speed=speed)
    if not acceptance_rules(profile):
        return
    ids = lambda frame: sorted(r["vendor_id"] for r in frame.select("vendor_id").collect())
    assert ids(clean(odd_trips, profile)) == ids(split_rejects(odd_trips, profile)[0])


def test_parquet_nan_is_null_and_rejected(spark, make_trips, tmp_path):
    raw = R.to_raw(make_trips({}, {"fare_amount": float("nan")}, {"total_amount": float("inf")}))
    raw.write.parquet(str(tmp_path / "raw"))
    trips = R.read_parquet(spark, str(tmp_path / "raw"))
    assert trips.filter("isnan(fare_amount) or isnan(total_amount)").isEmpty()
    assert build_silver(trips, "dbt").count() == 1


def reordered(raw):
    names = raw.columns
    a, b = names.index("fare_amount"), names.index("tip_amount")
    names[a], names[b] = names[b], names[a]
    return raw.select(*names)


def test_cells_are_bound_by_header(spark, make_trips, tmp_path):
    raw = reordered(R.to_raw(make_trips({"fare_amount": 20.0, "tip_amount": 4.0}))).drop("extra").withColumn("more", F.lit("x"))
    raw.write.option("header", True).csv(str(tmp_path / "csv"))
    row = R.read_lenient_csv(spark, str(tmp_path / "csv")).first()
    assert (row["fare_amount"], row["tip_amount"], row["extra"]) == (20.0, 4.0, 0.0)
    row = R.read_landed(spark, str(tmp_path / "csv")).first()
    assert (row["fare_amount"], row["tip_amount"], row["extra"]) == (20.0, 4.0, None)


def test_all_landed_formats_are_read_and_days_chosen(spark, make_trips, tmp_path):
    root = str(tmp_path / "landing")
    for day, fmt in enumerate(("csv", "jsonl", "parquet"), 1):
        W.land_raw(R.to_raw(make_trips({"vendor_id": day}, {"vendor_id": day})), root, dt.date(2024, 1, day), fmt=fmt)
    ids = lambda frame: sorted(r["vendor_id"] for r in frame.collect())
    assert ids(R.read_landed(spark, root)) == [1, 1, 2, 2, 3, 3]
    some = R.read_landed(spark, root, first="2024-01-02", last="2024-01-02")
    assert ids(some) == [2, 2]
    assert "PartitionFilters: [isnotnull" in some._jdf.queryExecution().toString()
    ingest_landing(spark, root, str(tmp_path / "raw"), str(tmp_path / "checkpoint")).awaitTermination()
    assert ids(spark.read.parquet(str(tmp_path / "raw"))) == [1, 1, 2, 2, 3, 3]


def test_expiry_keeps_at_least_one_version(spark):
    log = V.append_changes(spark.createDataFrame([(1, "a")], "k int, v string"), 1, dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="at least one"):
        V.expire_versions(log, ["k"], dt.datetime(2030, 1, 1), retain_last=0)
    assert V.expire_versions(log, ["k"], dt.datetime(2030, 1, 1), retain_last=1).count() == 1


def test_sums_do_not_depend_on_partitions(spark):
    cents = spark.range(0, 20_000_000).select((F.pmod(F.col("id") * 7919, F.lit(100_000)) / 100.0).alias("x"), "id")
    sums = {cents.repartition(n, "id").agg(X.exact_sum("x"), X.exact_avg("x")).first() for n in (3, 16)}
    assert len(sums) == 1
    assert next(iter(sums))[0] == cents.agg(F.sum(F.col("x").cast("decimal(12,2)"))).first()[0].__float__()


@pytest.mark.parametrize("partition", ["day", "_version"])
def test_compaction_settles(spark, tmp_path, partition):
    rows = spark.range(4000).select("id", F.hash("id").alias("x"))
    value = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 5)
    value = F.date_add(F.lit("2024-01-01"), value.cast("int")) if partition == "day" else value
    path = str(tmp_path / "log")
    rows.withColumn(partition, value).repartition(9).write.partitionBy(partition).parquet(path)
    first = ST.compact(spark, path, partition, ["id"], target_bytes=9_000)
    assert first.count() == 5 and all(r["files_after"] < r["files_before"] for r in first.collect())
    assert ST.compact(spark, path, partition, ["id"], target_bytes=9_000).count() == 0
    again = spark.read.parquet(path)
    assert again.count() == 4000 and again.filter(F.hash("id") != F.col("x")).isEmpty()
