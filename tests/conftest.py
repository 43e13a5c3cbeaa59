import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tripstrata.session import build_session

    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",  # plans are checked as text
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SMOKE


TRIP = {
    "vendor_id": 1,
    "pickup_datetime": "2024-01-10 12:00:00",
    "dropoff_datetime": "2024-01-10 12:30:00",
    "passenger_count": 2,
    "trip_distance": 5.0,
    "rate_code_id": 1,
    "store_and_fwd_flag": "N",
    "pu_location_id": 10,
    "do_location_id": 20,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 25.3,
    "congestion_surcharge": 2.5,
}


@pytest.fixture(scope="session")
def make_trips(spark):
    """Typed trips from dicts of changed fields; times may be text or None."""
    import datetime as dt

    from tripstrata.schemas import TRIP_SCHEMA

    def make(*changes):
        rows = []
        for change in changes:
            row = {**TRIP, **change}
            for name in ("pickup_datetime", "dropoff_datetime"):
                if isinstance(row[name], str):
                    row[name] = dt.datetime.fromisoformat(row[name])
            rows.append(tuple(row[f.name] for f in TRIP_SCHEMA))
        return spark.createDataFrame(rows, TRIP_SCHEMA)

    return make
