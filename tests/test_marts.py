"""Mart semantics: rounding of averages and totals, grouping, invariants."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL, trip
from tripmart import queries as Q
from tripmart.operators import marts
from tripmart.operators.curate import curate_trips
from tripmart.operators.quality import validate_trips
from tripmart.schemas import MONEY


def synthetic_trips(spark, n, miles, minutes=None, amount=None):
    """``n`` identical-grain curated-like rows built by Spark (no driver data)."""
    ids = spark.range(n)
    return ids.select(
        F.lit(dt.date(2024, 1, 15)).alias("trip_date"),
        F.lit("Monday").alias("day_of_week"),
        F.lit(False).alias("is_weekend"),
        F.lit(1).alias("PULocationID"),
        F.lit(2).alias("DOLocationID"),
        F.lit(False).alias("is_airport_trip"),
        F.lit(False).alias("shared_request_flag"),
        F.lit(False).alias("shared_match_flag"),
        F.lit(False).alias("wav_request_flag"),
        F.lit(False).alias("wav_match_flag"),
        miles(F.col("id")).cast(MONEY).alias("trip_miles"),
        (minutes(F.col("id")) if minutes else F.lit(1)).cast(MONEY).alias("trip_duration_minutes"),
        (amount(F.col("id")) if amount else F.lit(1)).cast(MONEY).alias("total_amount"),
        F.lit(1).cast(MONEY).alias("driver_pay"),
    )


def test_average_is_rounded_twice(spark, zones_df):
    # 5,000,001 x 1.00 and 4,999,999 x 1.01: mean 1.004999999 -> 1.005000 -> 1.01
    trips = synthetic_trips(spark, 10_000_000, lambda i: F.when(i < 5_000_001, 1.00).otherwise(1.01))
    r = marts.daily_zone(trips, zones_df).first()
    assert r.avg_zone_distance == Decimal("1.01")
    assert r.trip_count == 10_000_000


def test_summed_minutes_truncate(spark, zones_df):
    trips = synthetic_trips(spark, 2, lambda i: F.lit(1), minutes=lambda i: F.when(i == 0, 1.99).otherwise(1.00))
    r = marts.daily_borough(trips, zones_df).first()
    assert r.total_duration == 2


def test_total_overflow_is_null(spark, zones_df):
    trips = synthetic_trips(spark, 200, lambda i: F.lit(1), amount=lambda i: F.lit(Decimal("99999999.99")))
    r = marts.daily_service(trips).first()
    assert r.total_revenue is None and r.trip_count == 200


def test_service_counts_matches(spark, make_raw):
    rows = [trip(shared_match_flag="Y"), trip(shared_match_flag="Y", wav_match_flag="Y"), trip()]
    r = marts.daily_service(validate_trips(curate_trips(make_raw(*rows)))).first()
    assert (r.trip_count, r.shared_matched_count, r.wav_matched_count) == (3, 2, 1)
    assert (r.year, r.month) == (2024, 1)


def test_zone_names_and_partitions(spark, make_raw, zones_df):
    v = validate_trips(curate_trips(make_raw(trip(), trip(PULocationID=99))))
    rows = {r.PULocationID: r for r in marts.daily_zone(v, zones_df).collect()}
    assert rows[1].pickup_zone == "Midtown" and rows[1].dropoff_borough == "Queens"
    assert rows[99].pickup_zone is None and rows[99].dropoff_zone == "JFK Airport"
    assert (rows[1].year, rows[1].month, rows[1].day) == (2024, 1, 15)


def test_null_borough_forms_its_own_group(spark, make_raw, zones_df):
    v = validate_trips(curate_trips(make_raw(trip(), trip(PULocationID=99), trip(PULocationID=98))))
    rows = marts.daily_borough(v, zones_df).collect()
    by = {r.pickup_borough: r.trip_count for r in rows}
    assert by == {"Manhattan": 1, None: 2}


def test_trip_counts_agree_across_marts(spark):
    v = Q.valid(spark, SF_SMALL)
    z = Q.zones(spark, SF_SMALL)
    n = v.count()
    for name, build in marts.MARTS.items():
        assert build(v, z).agg(F.sum("trip_count")).first()[0] == n, name


def test_input_is_valid_plus_rejected(spark):
    r = Q.q_validation_report(spark, SF_SMALL).first()
    assert r.input_rows == r.valid_rows + r.rejected_rows
    assert r.valid_rows == Q.valid(spark, SF_SMALL).count()


def test_license_distribution_order(spark):
    rows = Q.q_license_distribution(spark, SF_SMALL).collect()
    counts = [r["count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
    assert len(rows) == 6 and None in {r.hvfhs_license_num for r in rows}
