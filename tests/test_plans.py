"""Physical plans keep the properties the design relies on."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tripstrata.operators import gold as G
from tripstrata.operators import ranking as R
from tripstrata.operators import upsert as U
from tripstrata.operators.clean import clean
from tripstrata.operators.silver import build_silver
from tripstrata.sources.adapters import trips_from_events
from tripstrata.sources.writers import write_parquet


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    trips = trips_from_events(spark, "/root/testdata/sf0.001")
    write_parquet(trips, str(root / "trips"))
    write_parquet(build_silver(trips, "dbt"), str(root / "silver"), partition_by=["pickup_date"])
    return spark.read.parquet(str(root / "trips")), spark.read.parquet(str(root / "silver"))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_uses_cross_joins_or_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_gates_reach_the_scan(stored):
    text = plan(clean(stored[0], "dbt"))
    for pushed in ("GreaterThanOrEqual(trip_distance,0.1)", "LessThanOrEqual(fare_amount,500.0)", "GreaterThan(total_amount,0.0)"):
        assert pushed in text


def test_gold_reads_only_its_columns(stored):
    text = plan(G.zone_stats(stored[1]))
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "tpep_pickup_datetime" not in schema and "do_location_id" not in schema and "vendor_id" not in schema
    assert "Expand" not in plan(G.gold_hour_zone(build_silver(stored[0], "strict")))


def test_latest_per_key_limits_groups_before_the_shuffle(stored):
    text = plan(U.dedupe_latest(stored[0], ["vendor_id"], [F.desc("pickup_datetime")]))
    below = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_sums_are_combined_before_the_shuffle(stored):
    text = plan(G.gold_hour_demo(build_silver(stored[0], "demo")))
    assert text.count("Exchange") == 1 and "partial_sum" in text.split("Exchange")[1]


def test_top_n_is_not_a_full_sort(stored):
    text = plan(R.top_pickup_zones(G.pickup_zone_counts(stored[1])))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_incremental_bound_prunes_partitions(spark, stored):
    loaded = stored[1].filter("pickup_date <= date'2024-01-20'")
    fresh = U.incremental_filter(stored[1], loaded)
    fresh.collect()
    text = plan(fresh)
    assert "PartitionFilters: [isnotnull(pickup_date" in text
    scan = text.split("PartitionFilters: [")[1]
    assert "subquery" in scan.split("]")[0].lower() or "Subquery" in scan
