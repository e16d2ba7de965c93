"""Hand-written edge rows (FIXTURES section 5) through curate + validate."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import trip
from tripmart.operators import quality
from tripmart.operators.curate import curate_trips
from tripmart.operators.enrich import DimensionError, check_zones, enrich_zones


def curated_rows(make_raw, *rows):
    return curate_trips(make_raw(*rows)).collect()


def test_half_up_on_shortest_decimal(make_raw):
    rows = curated_rows(make_raw, *[trip(tips=v) for v in (0.285, 1.005, 2.675, -0.005)])
    assert [r.tips for r in rows] == [Decimal("0.29"), Decimal("1.01"), Decimal("2.68"), Decimal("-0.01")]


def test_overflow_in_money_not_ruled_keeps_row(make_raw):
    df = curate_trips(make_raw(trip(tips=1e9)))
    r = df.first()
    assert r.tips is None and r.total_amount is None and r.total_fare is not None
    assert quality.validate_trips(df).count() == 1


def test_overflow_in_ruled_column_rejects_without_error(make_raw):
    df = curate_trips(make_raw(trip(base_passenger_fare=1e9)))
    assert df.first().base_passenger_fare is None
    assert quality.validate_trips(df).count() == 0
    assert quality.rejected_trips(df).count() == 1


def test_null_miles(make_raw):
    df = curate_trips(make_raw(trip(trip_miles=None, trip_time=600)))
    r = df.first()
    assert r.trip_miles == Decimal("0.00") and r.avg_speed_mph is None
    assert quality.validate_trips(df).count() == 1


@pytest.mark.parametrize("seconds", [0, -5, None])
def test_speed_null_for_non_positive_time(make_raw, seconds):
    r = curated_rows(make_raw, trip(trip_time=seconds))[0]
    assert r.avg_speed_mph is None


def test_speed_and_duration(make_raw):
    r = curated_rows(make_raw, trip(trip_miles=5.0, trip_time=1200))[0]
    assert r.avg_speed_mph == Decimal("15.00")
    assert r.trip_duration_minutes == Decimal("20.00")


def test_tiny_airport_fee(make_raw):
    r = curated_rows(make_raw, trip(airport_fee=0.004))[0]
    assert r.airport_fee == Decimal("0.00") and r.is_airport_trip is True


def test_null_airport_fee_is_not_airport(make_raw):
    r = curated_rows(make_raw, trip(airport_fee=None))[0]
    assert r.airport_fee == Decimal("0.00") and r.is_airport_trip is False


def test_flags(make_raw):
    rows = curated_rows(make_raw, *[trip(wav_match_flag=v) for v in ("Y", "y", " ", None)])
    assert [r.wav_match_flag for r in rows] == [True, False, False, False]


def test_totals_add_unrounded_values(make_raw):
    r = curated_rows(
        make_raw,
        trip(base_passenger_fare=10.004, tolls=0.004, bcf=0.0, sales_tax=0.0,
             congestion_surcharge=0.0, airport_fee=0.0, tips=0.004),
    )[0]
    # 10.008 -> 10.01 (the rounded columns would add to 10.00)
    assert r.total_fare == Decimal("10.01")
    assert r.total_amount == Decimal("10.01")
    assert r.base_passenger_fare == Decimal("10.00")


def test_cbd_fee_is_zero(make_raw):
    r = curated_rows(make_raw, trip())[0]
    assert r.cbd_congestion_fee == Decimal("0.00")


@pytest.mark.parametrize("miles,kept", [(-0.004, True), (500.004, True), (500.01, False)])
def test_miles_bounds_on_rounded_value(make_raw, miles, kept):
    df = curate_trips(make_raw(trip(trip_miles=miles)))
    assert quality.validate_trips(df).count() == (1 if kept else 0)


def test_time_order(make_raw):
    t = dt.datetime(2024, 1, 15, 10, 5, 0)
    same_drop = trip(pickup_datetime=t, dropoff_datetime=t)
    same_req = trip(pickup_datetime=t, request_datetime=t)
    df = curate_trips(make_raw(same_drop, same_req))
    valid = quality.validate_trips(df).collect()
    assert len(valid) == 1 and valid[0].request_datetime == valid[0].pickup_datetime


def test_null_request_or_license_rejects(make_raw):
    df = curate_trips(make_raw(trip(request_datetime=None), trip(hvfhs_license_num=None)))
    assert quality.validate_trips(df).count() == 0


def test_calendar_fields(make_raw):
    sat = dt.datetime(2024, 1, 13, 23, 30, 0)
    rows = curated_rows(make_raw, trip(pickup_datetime=sat), trip(pickup_datetime=None))
    assert (rows[0].day_of_week, rows[0].is_weekend, rows[0].pickup_hour) == ("Saturday", True, 23)
    assert (rows[0].year, rows[0].month, rows[0].day) == (2024, 1, 13)
    assert (rows[1].day_of_week, rows[1].is_weekend, rows[1].trip_date) == ("Unknown", False, None)


def test_late_trip_lands_in_pickup_month(make_raw):
    feb = dt.datetime(2024, 2, 1, 0, 10, 0)
    r = curated_rows(make_raw, trip(year=2024, month=1, request_datetime=feb,
                                    pickup_datetime=feb, dropoff_datetime=feb + dt.timedelta(minutes=9)))[0]
    assert (r.year, r.month, r.day) == (2024, 2, 1)


def test_report_counts_every_rule(make_raw):
    df = curate_trips(make_raw(trip(), trip(PULocationID=None), trip(trip_miles=600.0, hvfhs_license_num="X")))
    r = quality.validation_report(df).first()
    assert (r.input_rows, r.valid_rows, r.rejected_rows) == (3, 1, 2)
    assert r.rejected_pct == Decimal("66.6667")
    assert r.failed_pu_location_not_null == 1 and r.failed_miles_max == 1 and r.failed_license_known == 1


def test_report_on_empty_input(make_raw):
    r = quality.validation_report(curate_trips(make_raw())).first()
    assert (r.input_rows, r.valid_rows, r.rejected_pct) == (0, 0, None)


def test_duplicate_zone_id_fails_before_join(spark, make_raw, zones_df):
    dup = zones_df.unionByName(zones_df.where(F.col("LocationID") == 1))
    with pytest.raises(DimensionError):
        check_zones(dup)
    with pytest.raises(DimensionError):
        enrich_zones(curate_trips(make_raw(trip())), dup)


def test_unknown_zone_keeps_trip(make_raw, zones_df):
    e = enrich_zones(curate_trips(make_raw(trip(PULocationID=99))), zones_df).first()
    assert e.pickup_borough is None and e.dropoff_borough == "Queens"


def test_no_python_udf_in_curate_plan(make_raw):
    plan = curate_trips(make_raw(trip()))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cbd_fee_option_reads_the_source_column(make_raw):
    raw = make_raw(trip(tips=0.0)).withColumn("cbd_congestion_fee", F.lit(0.75))
    default = curate_trips(raw).first()
    with_fee = curate_trips(raw, use_cbd_fee=True).first()
    assert default.cbd_congestion_fee == Decimal("0.00")
    assert with_fee.cbd_congestion_fee == Decimal("0.75")
    assert with_fee.total_fare - default.total_fare == Decimal("0.75")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_result_with_ansi_on_or_off(spark, make_raw, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [trip(tips=1e9), trip(base_passenger_fare=1e9), trip(trip_miles=500.004), trip(trip_time=0)]
        df = curate_trips(make_raw(*rows))
        got = [(r.tips, r.base_passenger_fare, r.trip_miles, r.avg_speed_mph) for r in df.collect()]
        assert got[0][0] is None and got[1][1] is None and got[2][2] == Decimal("500.00")
        assert got[3][3] is None
        assert quality.validate_trips(df).count() == 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
