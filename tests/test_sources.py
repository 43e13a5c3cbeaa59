"""Readers, writers, layouts and synthetic trips."""

import datetime as dt
import gzip

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripstrata.operators.clean import clean
from tripstrata.operators.quality import DataQualityError
from tripstrata.schemas import RAW_SCHEMA, TRIP_SCHEMA
from tripstrata.sources import layout as L
from tripstrata.sources import readers as R
from tripstrata.sources import synthetic as S
from tripstrata.sources import writers as W

HEADER = ",".join(RAW_SCHEMA.names)
GOOD = "1,2024-01-10 12:00:00,2024-01-10 12:30:00,2,5.0,1,N,10,20,1,20.0,0.5,0.5,4.0,0,0.3,25.3,2.5"


def csv_file(folder, *lines, name="trips.csv", header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder / name)


def test_strict_csv(spark, tmp_path):
    bad = GOOD.replace("20.0", "abc").replace("2024-01-10 12:00:00", "soon")
    trips = R.read_raw_csv(spark, csv_file(tmp_path, GOOD, bad))
    assert [(f.name, f.dataType) for f in trips.schema] == [(f.name, f.dataType) for f in TRIP_SCHEMA]
    rows = trips.orderBy(F.desc_nulls_last("pickup_datetime")).collect()
    assert rows[0]["pickup_datetime"] == dt.datetime(2024, 1, 10, 12)
    assert (rows[1]["pickup_datetime"], rows[1]["fare_amount"], rows[1]["total_amount"]) == (None, None, 25.3)


def test_strict_csv_rejects_another_header(spark, tmp_path):
    path = csv_file(tmp_path, GOOD, header=HEADER.replace("VendorID", "Vendor"))
    with pytest.raises(Exception, match="header"):
        R.read_raw_csv(spark, path).collect()


def test_lenient_csv(spark, tmp_path):
    quoted = ",".join(f'" {cell} "' for cell in GOOD.split(","))
    empty_cells = "1,2024-01-10 13:00:00,2024-01-10 13:30:00,,5.0,1,,10,20,1,20.0,,,,,,25.3,"
    short = "1,2024-01-10 14:00:00,2024-01-10 14:30:00"
    words = GOOD.replace("12:00", "15:00").replace("12:30", "15:30").replace(",20.0,", ",12abc,")
    nan = GOOD.replace("12:00", "16:00").replace("12:30", "16:30").replace(",20.0,", ",NaN,")
    trips = R.read_lenient_csv(spark, csv_file(tmp_path, quoted, "", empty_cells, short, words, nan))
    rows = {row["pickup_datetime"].hour: row for row in trips.collect()}
    assert sorted(rows) == [12, 13, 14, 15, 16]
    assert (rows[12]["vendor_id"], rows[12]["fare_amount"], rows[12]["store_and_fwd_flag"]) == (1, 20.0, "N")
    assert (rows[13]["passenger_count"], rows[13]["tip_amount"], rows[13]["store_and_fwd_flag"]) == (0, 0.0, "N")
    assert rows[14]["fare_amount"] == 0.0
    assert rows[15]["fare_amount"] is None and rows[16]["fare_amount"] is None
    assert {row["pickup_datetime"].hour for row in clean(trips, "demo").collect()} == {12, 13}
    assert {row["pickup_datetime"].hour for row in clean(trips, "strict").collect()} == {12}


def test_parquet_with_other_types_is_conformed(spark, tmp_path, make_trips):
    raw = R.to_raw(make_trips({}, {"passenger_count": None}))
    wide = raw.withColumns({"passenger_count": F.col("passenger_count").cast("double"), "VendorID": F.col("VendorID").cast("bigint")})
    path = R.monthly_file(str(tmp_path), 2024, 1)
    assert path.endswith("yellow_tripdata_2024-01.parquet")
    W.write_parquet(wide.drop("extra"), path)
    trips = R.read_parquet(spark, path)
    assert trips.schema["passenger_count"].dataType == TRIP_SCHEMA["passenger_count"].dataType
    assert sorted(map(str, (row["passenger_count"] for row in trips.collect()))) == ["2", "None"]
    assert trips.filter(F.col("extra").isNotNull()).count() == 0


def test_landing_folder_mixes_formats(spark, tmp_path, make_trips):
    root = str(tmp_path / "landing")
    raw = R.to_raw(make_trips({}))
    W.land_raw(raw, root, dt.date(2024, 1, 10))
    assert R.read_landed(spark, root).count() == 1  # no Parquet file yet
    W.land_raw(raw, root, dt.date(2024, 1, 11), fmt="parquet")
    W.land_raw(raw, root, dt.date(2024, 1, 11), fmt="csv")
    landed = R.read_landed(spark, root)
    assert landed.columns == TRIP_SCHEMA.names
    assert landed.count() == 3 and landed.distinct().count() == 1
    assert (tmp_path / "landing" / "year=2024" / "month=01" / "day=11").is_dir()
    W.land_raw(raw, str(tmp_path / "monthly"), dt.date(2024, 1, 11), daily=False)
    assert (tmp_path / "monthly" / "year=2024" / "month=01").is_dir()


def test_json_lines(spark, tmp_path, make_trips):
    W.write_json_lines(make_trips({}), str(tmp_path / "plain"))
    W.write_json_lines(make_trips({}, {}), str(tmp_path / "zipped"), gzip=True)
    text = "".join(gzip.open(part, "rt").read() for part in (tmp_path / "zipped").glob("*.json.gz"))
    assert text.count('"vendor_id":1') == 2
    assert spark.read.json(str(tmp_path / "zipped")).count() == 2
    W.land_raw(make_trips({}), str(tmp_path / "landed"), dt.date(2024, 1, 1), fmt="jsonl")
    assert list((tmp_path / "landed").rglob("*.json.gz"))


def test_catalog_tables(spark, make_trips):
    silver = make_trips({}, {"pickup_datetime": "2024-01-11 10:00:00", "dropoff_datetime": "2024-01-11 11:00:00"})
    silver = L.with_partition(silver, "pickup_datetime", "day", "pickup_date")
    W.ensure_database(spark, "lake")
    for _ in range(2):  # create, then replace
        W.write_table(silver, "lake.trips", partition_by=["pickup_date"], sort_by=["pickup_datetime"])
    W.write_table(silver.groupBy("pu_location_id").count(), "lake.zones")
    assert R.read_table(spark, "lake.trips").count() == 2
    assert {row["table"] for row in W.list_tables(spark, "lake").collect()} == {"trips", "zones"}
    assert "lake" in {row[0] for row in W.list_databases(spark).collect()}
    assert spark.catalog.getTable("lake.trips") and [c.name for c in spark.catalog.listColumns("lake.trips") if c.isPartition] == ["pickup_date"]


def test_jdbc_options():
    """The reader itself is not run: it would need a database."""
    plain = R.jdbc_options("jdbc:x:y", "runs", properties={"user": "u"})
    assert plain == {"url": "jdbc:x:y", "dbtable": "runs", "fetchsize": "10000", "user": "u"}
    ranged = R.jdbc_options("jdbc:x:y", "runs", "id", 1, 1000, 8)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("id", "1", "1000", "8")
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x:y", "runs", partitions=4)
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x:y", "runs", "id", partitions=4)


def test_evolving_schema(spark, tmp_path):
    spark.sql("select 1 a").write.parquet(str(tmp_path / "t" / "part=1"))
    spark.sql("select 2 a, 'x' b").write.parquet(str(tmp_path / "t" / "part=2"))
    rows = R.read_evolving_parquet(spark, str(tmp_path / "t")).orderBy("a").collect()
    assert [(row["a"], row["b"]) for row in rows] == [(1, None), (2, "x")]


def test_partition_values(spark):
    moment = spark.sql("select timestamp_ntz'2024-05-17 13:45:10' t")
    got = moment.select(*[L.partition_value("t", g).cast("string").alias(g) for g in L.GRANULARITIES]).first()
    assert tuple(got) == ("2024-05-17 13:00:00", "2024-05-17", "2024-05-01", "2024-01-01", "2024-05-17 13:45:10")


def test_files_of_a_table_are_listed_one_by_one(spark, tmp_path):
    """The query ``file_listing`` has one file a table; here a table has several, each held against its file."""
    path = str(tmp_path / "events.parquet")
    for rows in (3, 5, 11):
        spark.range(rows).coalesce(1).write.mode("append").parquet(path)
    stored = {f.name: (f.stat().st_size, pq.read_metadata(f).num_rows) for f in (tmp_path / "events.parquet").glob("*.parquet")}
    listed = {r["file_path"].rpartition("/")[2]: (r["bytes"], r["rows"]) for r in L.list_files(spark.read.parquet(path)).collect()}
    assert listed == stored and sorted(n for _, n in listed.values()) == [3, 5, 11]


def test_inventory_and_manifest(spark, tmp_path, make_trips):
    path, rows = str(tmp_path / "silver"), L.with_partition(make_trips({}, {}), "pickup_datetime", "day", "pickup_date")
    W.write_parquet(rows, path, partition_by=["pickup_date"])
    stored = spark.read.parquet(path)
    assert [(r["files"], r["rows"]) for r in L.stored_manifest(stored).collect()] == [(1, 2)]
    assert L.list_files(stored).first()["bytes"] > 0
    inventory = L.layer_inventory(spark, {"silver": path, "gold": str(tmp_path / "gold")})
    assert {(r["layer"], r["files"], r["rows"]) for r in inventory.collect()} == {("silver", 1, 2), ("gold", 0, 0)}
    with pytest.raises(DataQualityError, match="gold"):
        L.require_layers(inventory)


def test_synthetic_trips(spark):
    trips = S.synthetic_trips(spark, 4000, 2024, 3, seed=7).cache()
    assert trips.columns == TRIP_SCHEMA.names and trips.count() == 4000
    row = trips.agg(
        F.min("pickup_datetime"), F.max("pickup_datetime"), F.min("fare_amount"), F.max("trip_distance"),
        F.avg((F.col("payment_type") == 1).cast("double")), F.max(F.col("pu_location_id")),
        F.count_if((F.col("payment_type") != 1) & (F.col("tip_amount") > 0)),
        F.count_if(F.col("dropoff_datetime") < F.expr("pickup_datetime + interval 2 minutes")),
        F.count_if(F.abs(F.expr("fare_amount + tip_amount + extra + mta_tax + improvement_surcharge + tolls_amount + congestion_surcharge") - F.col("total_amount")) > 0.006),
    ).first()
    assert row[0] >= dt.datetime(2024, 3, 1) and row[1] < dt.datetime(2024, 3, 29)
    assert row[2] >= 3.0 and row[3] <= 50.0 and 0.6 < row[4] < 0.7 and row[5] <= 265
    assert tuple(row)[6:] == (0, 0, 0)
    again = S.synthetic_trips(spark, 4000, 2024, 3, seed=7)
    assert again.exceptAll(trips).count() == 0
    assert trips.filter(F.hour("pickup_datetime") == 17).count() > 3 * trips.filter(F.hour("pickup_datetime") == 3).count()


def test_uniform_trips(spark):
    trips = S.uniform_trips(spark, 500, miles=(0.5, 18.0))
    assert trips.count() == 500
    assert trips.filter("trip_distance > 18 or fare_amount < 3.75").count() == 0
    assert clean(trips, "demo").count() == 500
