from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmart.schemas import RAW_LANDED  # noqa: E402
from tripmart.session import builder  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = builder("local[4]", 8).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


BASE_TRIP = {
    "hvfhs_license_num": "HV0003",
    "dispatching_base_num": "B1",
    "originating_base_num": "B1",
    "request_datetime": dt.datetime(2024, 1, 15, 10, 0, 0),
    "on_scene_datetime": dt.datetime(2024, 1, 15, 10, 2, 0),
    "pickup_datetime": dt.datetime(2024, 1, 15, 10, 5, 0),
    "dropoff_datetime": dt.datetime(2024, 1, 15, 10, 25, 0),
    "PULocationID": 1,
    "DOLocationID": 2,
    "trip_miles": 5.0,
    "trip_time": 1200,
    "base_passenger_fare": 20.0,
    "tolls": 0.0,
    "bcf": 0.5,
    "sales_tax": 1.5,
    "congestion_surcharge": 2.75,
    "airport_fee": 0.0,
    "tips": 3.0,
    "driver_pay": 15.0,
    "shared_request_flag": "N",
    "shared_match_flag": "N",
    "access_a_ride_flag": "N",
    "wav_request_flag": "N",
    "wav_match_flag": "N",
    "year": 2024,
    "month": 1,
}


def trip(**overrides):
    row = dict(BASE_TRIP)
    row.update(overrides)
    return tuple(row[f.name] for f in RAW_LANDED.fields)


@pytest.fixture
def make_raw(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), RAW_LANDED)

    return make


@pytest.fixture
def zones_df(spark):
    from tripmart.schemas import ZONE

    rows = [
        (1, "Manhattan", "Midtown", "Yellow Zone"),
        (2, "Queens", "JFK Airport", "Airports"),
        (3, "Brooklyn", "Park Slope", "Boro Zone"),
    ]
    return spark.createDataFrame(rows, ZONE)
