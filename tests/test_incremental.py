"""Upsert, incremental selection and the stored merge."""

import pytest
from pyspark.sql import functions as F

from tripstrata.operators import stored as ST
from tripstrata.operators import upsert as U
from tripstrata.operators.silver import build_silver, newest_per_key
from tripstrata.schemas import MERGE_KEYS
from tripstrata.sources import files
from tripstrata.sources.adapters import trips_from_events

KEYS = ["k"]


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


def content(frame):
    return sorted(tuple(row) for row in frame.collect())


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_upsert_replaces_and_inserts(spark):
    merged = U.merge_upsert(table(spark, ("a", 1), ("b", 2), ("b", 3)), table(spark, ("b", 9), ("c", 4)), KEYS)
    assert content(merged) == [("a", 1), ("b", 9), ("c", 4)]


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1)], "k string, v int")
    once = U.merge_upsert(target, spark.createDataFrame([(None, 2), (None, 3)], "k string, v int"), KEYS)
    assert sorted(row["v"] for row in once.collect()) == [1, 2, 3]


def test_ambiguous_updates_fail(spark):
    updates = table(spark, ("b", 1), ("b", 2))
    with pytest.raises(Exception, match="dedupe first"):
        U.merge_upsert(table(spark, ("a", 1)), updates, KEYS).collect()
    deduped = U.dedupe_latest(updates, KEYS, [F.desc("v")])
    assert content(U.merge_upsert(table(spark, ("a", 1)), deduped, KEYS)) == [("a", 1), ("b", 2)]
    merged = U.merge_upsert(table(spark, ("a", 1), ("b", 7)), updates, KEYS, latest=[F.desc("v")])
    assert content(merged) == [("a", 1), ("b", 2)]


def test_dedupe_against_brute_force(spark):
    rows = [(f"k{i % 7 if i % 3 else 0}", (i * 37) % 101) for i in range(500)]  # k0 holds a third and more
    best = {}
    for key, value in rows:
        best[key] = max(value, best.get(key, -1))
    assert content(U.dedupe_latest(table(spark, *rows), KEYS, [F.desc("v")])) == sorted(best.items())


def test_incremental_bounds(spark):
    source = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) pickup_date")
    target = source.filter("pickup_date <= date'2024-01-07'")
    assert U.incremental_filter(source, target).count() == 4  # the newest loaded day comes again
    assert U.incremental_filter(source, target, lookback_days=3).count() == 7
    assert U.incremental_filter(source, target.filter("false")).count() == 10
    assert U.incremental_filter(source, None).count() == 10
    assert str(U.watermark(target.filter("false")).first()[0]) == "2019-01-01"


def test_extract_and_bookmark(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 5, "c"), (3, 4, "d")], "id int, updated_at int, x string")
    got = U.incremental_extract(rows, ["id"], "updated_at", 5)
    assert sorted(row["x"] for row in got.collect()) == ["b", "c"]
    assert U.next_bookmark(rows, "updated_at").first()[0] == 7
    assert U.incremental_extract(rows, ["id"], "updated_at", None).count() == 3


@pytest.fixture
def silver(spark, sf_dir):
    return build_silver(trips_from_events(spark, sf_dir), "dbt")


def test_stored_merge_is_idempotent_and_touches_few_partitions(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    ST.merge_into_path(spark, path, silver.filter("pickup_date <= date'2024-01-15'"), MERGE_KEYS)
    old_files = {f.name for f in (tmp_path / "silver").rglob("pickup_date=2024-01-05/*.parquet")}
    updates = newest_per_key(silver.filter("pickup_date >= date'2024-01-14'")).withColumn("fare_amount", F.col("fare_amount") + 1)
    expected = U.merge_upsert(spark.read.parquet(path), updates, MERGE_KEYS)
    expected = spark.createDataFrame(expected.collect(), expected.schema)
    for _ in range(2):
        ST.merge_into_path(spark, path, updates, MERGE_KEYS)
        assert same(spark.read.parquet(path).select(*silver.columns), expected.select(*silver.columns))
    assert {f.name for f in (tmp_path / "silver").rglob("pickup_date=2024-01-05/*.parquet")} == old_files
    assert not files.exists(spark, path + "__merging")


def test_merge_interrupted_before_publishing_is_finished(spark, silver, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    ST.merge_into_path(spark, path, silver.filter("pickup_date <= date'2024-01-15'"), MERGE_KEYS)
    updates = newest_per_key(silver.filter("pickup_date >= date'2024-01-14'"))
    total = silver.count()

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ST, "finish_merge", lambda *a: False if not files.exists(spark, path + "__merging") else stop())
        with pytest.raises(RuntimeError, match="lost"):
            ST.merge_into_path(spark, path, updates, MERGE_KEYS)
    assert spark.read.parquet(path).count() < total
    assert ST.finish_merge(spark, path)
    assert spark.read.parquet(path).count() == total
    assert not ST.finish_merge(spark, path)


def test_compaction_keeps_rows(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    silver.repartition(6).write.partitionBy("pickup_date").parquet(path)
    digest = lambda: spark.read.parquet(path).select(F.sum(F.xxhash64(*silver.columns).cast("decimal(38,0)")), F.count("*")).first()
    before = digest()
    stats = ST.compact(spark, path, sort_by=["tpep_pickup_datetime"]).collect()
    assert digest() == before
    assert len(stats) == 30
    assert all(r["files_after"] == 1 < r["files_before"] and r["rows_after"] == r["rows_before"] for r in stats)
    assert ST.compact(spark, path, sort_by=["tpep_pickup_datetime"]).count() == 0


def test_compaction_splits_a_large_day(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    hot = silver.withColumn("pickup_date", F.when(F.rand(1) < 0.5, F.lit("2024-01-03")).otherwise(F.col("pickup_date").cast("string")).cast("date"))
    hot.repartition(16).write.partitionBy("pickup_date").parquet(path)
    rows = spark.read.parquet(path).count()
    ST.compact(spark, path, sort_by=["tpep_pickup_datetime"], target_bytes=20_000)
    assert spark.read.parquet(path).count() == rows
    assert 1 < len(list((tmp_path / "silver").rglob("pickup_date=2024-01-03/*.parquet"))) < 16


def test_maintenance_goes_on_after_a_failure(spark):
    done = []
    result = ST.run_maintenance(spark, {"a": lambda: 1 / 0, "b": lambda: done.append(1)})
    assert {(r["table"], r["status"]) for r in result.collect()} == {("a", "failed"), ("b", "success")}
    assert done == [1]
