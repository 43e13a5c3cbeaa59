"""Ranks over whole tables by ranges: equal to the windows they stand for, and no task sees all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripstrata import functions as X
from tripstrata.operators import ranking as R


def by_windows(stats):
    whole, zone = Window.partitionBy(), F.col("location_id")
    names = {"revenue_rank": "total_revenue", "volume_rank": "trip_count", "avg_fare_rank": "avg_fare"}
    ranks = {name: F.row_number().over(whole.orderBy(F.desc(metric), zone)) for name, metric in names.items()}
    percentile = F.percent_rank().over(whole.orderBy("total_revenue")) * 100
    return stats.withColumns({**ranks, "revenue_percentile": X.round_half_up(percentile, 1)})


def zones(spark, n):
    """A third of the zones earn the same, a few earn an unknown amount."""
    value = F.pmod(F.xxhash64("id"), F.lit(n))
    return spark.range(n).select(
        F.col("id").alias("location_id"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 1000 != 7, value / 4).alias("total_revenue"),
        (value % 50).alias("trip_count"),
        F.round(value / 7, 2).alias("avg_fare"),
        F.lit("kept").alias("place"),
    )


def nodes(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_zone_ranks_equal_windows(spark, n):
    stats = zones(spark, n)
    want = by_windows(stats)
    got = R.rank_zones(stats)
    assert got.columns == [*want.columns, "revenue_tier"]
    assert sorted(map(tuple, got.drop("revenue_tier").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_million_zones_without_a_window_over_all(spark):
    stats = zones(spark, 1_000_000)
    got = R.rank_zones(stats)
    assert "Window" not in nodes(got)
    found = got.agg(*[F.sum(F.pmod(F.xxhash64("location_id", n), F.lit(1 << 31))).alias(n) for n in ("revenue_rank", "volume_rank", "avg_fare_rank", "revenue_percentile")]).first()
    want = by_windows(stats).agg(*[F.sum(F.pmod(F.xxhash64("location_id", n), F.lit(1 << 31))).alias(n) for n in ("revenue_rank", "volume_rank", "avg_fare_rank", "revenue_percentile")]).first()
    assert found == want


def test_a_zone_without_id_and_names_used_inside(spark):
    stats = zones(spark, 40).withColumn("location_id", F.when(F.col("location_id") != 7, F.col("location_id")))
    got = R.rank_zones(stats).drop("revenue_tier")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, by_windows(stats).collect()), key=repr)
    rows = spark.range(100).selectExpr("id", "id as _at", "id as _PART", "id as _before", "id as _at_")
    placed = R.with_position(rows, [F.desc("id")], "place")
    assert placed.columns == [*rows.columns, "place"]
    assert all(r["place"] == 99 - r["id"] and r["_at"] == r["_PART"] == r["_before"] == r["id"] for r in placed.collect())


def test_places_when_all_rows_share_the_first_column(spark):
    rows = spark.range(20_000).selectExpr("1 as same", "id")
    placed = R.with_position(rows, [F.col("same"), F.col("id")], "place")
    assert placed.filter("place <> id").count() == 0
