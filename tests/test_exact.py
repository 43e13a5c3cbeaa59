"""Exact sums and distinct counts in one aggregation."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripstrata import functions as X
from tripstrata.operators import gold as G
from tripstrata.operators.silver import build_silver
from tripstrata.sources.adapters import trips_from_events
from tripstrata.sources.writers import write_parquet


def total(spark, values, parts=3, **known):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double").repartition(parts, "id")
    return frame.agg(X.exact_sum("x", **known).alias("s"), X.exact_avg("x", **known).alias("a")).first()


@pytest.mark.parametrize("values, want", [([1.0, 1e15], 1e15 + 1), ([9e14, 9e14], 1.8e15), ([1e17, -1e17, 0.25], 0.25), ([0.1] * 10, 1.0), ([-0.01, -1234.56], -1234.57)])
def test_sums_of_any_size(spark, values, want):
    row = total(spark, values)
    assert row["s"] == want and row["a"] == pytest.approx(want / len(values), rel=1e-15)


def test_inputs_are_not_rounded(spark):
    row = total(spark, [n / 60 for n in range(1, 60)])
    assert abs(Fraction(row["s"]) - sum(Fraction(n / 60) for n in range(1, 60))) < Fraction(1, 10**10)
    assert total(spark, [1 / 60])["a"] == pytest.approx(1 / 60, abs=1e-12)
    assert total(spark, [1 / 60] * 3, bounded=True)["a"] == pytest.approx(1 / 60, abs=1e-12)


def test_sums_do_not_depend_on_order_and_nulls_are_no_values(spark):
    values = [((i * 7919) % 100_003) / 7 * (10 ** (i % 12)) for i in range(2000)]
    assert len({total(spark, values, n)["s"] for n in (1, 3, 16)}) == 1
    assert total(spark, [None, 2.5, None]) == (2.5, 2.5)
    assert total(spark, [None, None]) == (None, None)


def test_values_beyond_every_limb(spark):
    assert total(spark, [1e300, 2.0])["s"] == 1e300
    assert total(spark, [math.inf, 2.0])["s"] == math.inf
    assert math.isnan(total(spark, [math.nan, 2.0])["s"])


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    write_parquet(build_silver(trips_from_events(spark, "/root/testdata/sf0.01"), "dbt"), path, partition_by=["pickup_date"])
    return spark.read.parquet(path)


def test_hours_read_silver_once(silver):
    text = plan(G.gold_daily_hourly(silver))
    assert text.count("FileScan") == 1 and "Expand" not in text and "Join" not in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("pickup", ["pu_location_id", "-pu_location_id", "pu_location_id * 1000003", "if(pu_location_id % 2 = 0, null, pu_location_id * 64)", "319 + pu_location_id % 3", "cast(null as int)"])
def test_distinct_zones_of_any_ids(silver, pickup):
    rows = silver.withColumn("pu_location_id", F.expr(f"cast({pickup} as bigint)")).withColumn("do_location_id", F.expr("if(do_location_id % 5 = 0, -do_location_id, do_location_id)"))
    got = G.gold_daily_hourly(rows).select("pickup_date", "pickup_hour", "trip_count", "unique_pickup_zones", "unique_dropoff_zones")
    want = rows.groupBy("pickup_date", "pickup_hour").agg(F.count("*").alias("trip_count"), F.count_distinct("pu_location_id"), F.count_distinct("do_location_id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_words_at_their_edges(spark):
    ids = X.DistinctIds("id", 2)
    frame = spark.createDataFrame([(i,) for i in (0, 0, 63, 64, 127, 128, -1, None)], "id long")
    words = [F.bit_or(w).alias(f"w{k}") for k, w in enumerate(ids.words())]
    assert frame.agg(*words).select(ids.count([F.col("w0"), F.col("w1")])).first()[0] == 4
    assert sorted(r[0] for r in frame.select(ids.outside()).collect() if r[0] is not None) == [-1, 128]
