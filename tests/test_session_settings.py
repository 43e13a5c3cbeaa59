"""Results do not depend on the caller's session settings."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import oracle_sql, queries

NAMES = ["gold_daily_hourly", "silver_strict", "partition_granularity", "expire_versions", "safe_divide", "incremental_extract"]


@pytest.mark.parametrize(
    "setting, value",
    [
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.adaptive.enabled", "false"),
        ("spark.sql.shuffle.partitions", "37"),
    ],
)
def test_same_results(spark, sf_dir, setting, value):
    con, before = connect(sf_dir), spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        for name in NAMES:
            assert compare(spark, con, sf_dir, queries()[name], oracle_sql()[name]) == [], name
    finally:
        spark.conf.set(setting, before)


def test_skewed_keys_give_the_same_results(spark, tmp_path):
    """A third of all trips in one zone and hour: results still equal the SQL."""
    from pyspark.sql import functions as F

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hot = F.rand(5) < 0.34
    skewed = events.withColumns(
        {
            "ts": F.when(hot, F.lit("2024-01-03 08:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")),
            "user_id": F.when(hot, F.lit(7)).otherwise(F.col("user_id")),
        }
    )
    sf_dir = tmp_path / "skewed"
    skewed.coalesce(1).write.parquet(str(sf_dir / "events.parquet"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet/*.parquet')")
    for name in ("gold_daily_summary", "gold_location_performance", "merge_upsert", "incremental_extract", "as_of_version"):
        assert compare(spark, con, str(sf_dir), queries()[name], oracle_sql()[name]) == [], name
