"""Writes, one-month refresh, and incremental runs."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import trip
from tripmart.plans.jobs import EmptyInputError, build_aggregates, build_curated
from tripmart.sources.landing import land_raw
from tripmart.sources.tables import month_target, scan_curated
from tripmart.streaming.incremental import (
    CheckpointMismatch,
    read_curated,
    refresh_aggregates,
    refresh_curated,
    write_curated_batch,
)


def day(d, hour=10, minute=0, month=1):
    t = dt.datetime(2024, month, d, hour, minute)
    return dict(request_datetime=t - dt.timedelta(minutes=3), pickup_datetime=t,
                dropoff_datetime=t + dt.timedelta(minutes=20), month=month)


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_build_curated_and_aggregates(spark, make_raw, zones_df, scratch):
    raw = make_raw(trip(**day(1)), trip(**day(1, 11)), trip(**day(2)), trip(PULocationID=None))
    land_raw(raw, f"{scratch}/raw")
    rep = build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    assert (rep.input_rows, rep.output_rows["curated_trips"], rep.rejected_rows) == (4, 3, 1)
    assert os.path.isdir(f"{scratch}/cur/year=2024/month=1/day=1")
    agg = build_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/marts")
    assert agg.input_rows == 3
    assert agg.output_rows == {"daily_borough": 2, "daily_zone": 2, "daily_service": 2}
    assert os.path.isdir(f"{scratch}/marts/daily_zone/year=2024/month=1/day=2")
    assert os.path.isdir(f"{scratch}/marts/daily_borough/year=2024/month=1")
    b = spark.read.parquet(f"{scratch}/marts/daily_borough")
    assert rows_of(b, "trip_date", "trip_count") == [(dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 2), 1)]


def test_empty_input_raises_in_full_mode(spark, make_raw, zones_df, scratch):
    land_raw(make_raw(trip()), f"{scratch}/raw")
    with pytest.raises(EmptyInputError):
        build_curated(spark, f"{scratch}/raw", f"{scratch}/cur", raw=make_raw())
    build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    with pytest.raises(EmptyInputError):
        build_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/m", 2023, 5)


def test_one_target_parameter_only_is_an_error():
    with pytest.raises(ValueError):
        month_target(2024, None)
    with pytest.raises(ValueError):
        month_target(None, "02")
    assert month_target("2024", "02") == (2024, 2)


def test_targeted_refresh_keeps_other_months(spark, make_raw, zones_df, scratch):
    raw = make_raw(trip(**day(5, month=1)), trip(**day(6, month=2)))
    land_raw(raw, f"{scratch}/raw")
    build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    build_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/m")
    # February gets a second trip; only February is re-read and replaced.
    more = make_raw(trip(**day(6, month=2)), trip(**day(7, month=2)))
    land_raw(more, f"{scratch}/raw", mode="dynamic")
    build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    rep = build_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/m", "2024", "02")
    assert rep.input_rows == 2
    svc = spark.read.parquet(f"{scratch}/m/daily_service")
    assert rows_of(svc, "month", "trip_date", "trip_count") == [
        (1, dt.date(2024, 1, 5), 1), (2, dt.date(2024, 2, 6), 1), (2, dt.date(2024, 2, 7), 1)]


def test_targeted_scan_is_pruned(spark, make_raw, scratch):
    land_raw(make_raw(trip(**day(5, month=1)), trip(**day(6, month=2))), f"{scratch}/raw")
    build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    from tripmart.sources.tables import scan_target_month

    df = scan_target_month(spark, f"{scratch}/cur", "2024", "02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan
    assert df.count() == 1


def test_append_adds_rows(spark, make_raw, scratch):
    from tripmart.sinks import write_table

    from tripmart.operators.curate import curate_trips

    c = curate_trips(make_raw(trip(**day(3))))
    write_table(c, f"{scratch}/t", ["year", "month", "day"], mode="overwrite")
    write_table(c, f"{scratch}/t", ["year", "month", "day"], mode="append")
    assert scan_curated(spark, f"{scratch}/t").count() == 2
    write_table(c, f"{scratch}/t", ["year", "month", "day"], mode="overwrite")
    assert scan_curated(spark, f"{scratch}/t").count() == 1


def test_incremental_runs_only_new_files_and_replays_safely(spark, make_raw, zones_df, scratch):
    raw, cur, ck = f"{scratch}/raw", f"{scratch}/cur", f"{scratch}/ck"
    # Two batches carry trips of the same day.
    land_raw(make_raw(trip(**day(9, 8)), trip(**day(10, 8))), raw, mode="dynamic")
    first = refresh_curated(spark, raw, cur, ck)
    assert sum(b["valid_rows"] for b in first) == 2
    assert refresh_curated(spark, raw, cur, ck) == []  # nothing new: no batch, no error
    land_raw(make_raw(trip(**day(9, 20, month=2)), trip(**day(9, 21, month=2))), raw, mode="dynamic")
    # A late file for January adds one more trip of day 9.
    land_raw(make_raw(trip(**day(9, 18))), raw, mode="append")
    second = refresh_curated(spark, raw, cur, ck)
    assert sum(b["input_rows"] for b in second) == 3
    # A batch replayed after a failure rewrites its own partitions only.
    replay = make_raw(trip(**day(9, 20, month=2)), trip(**day(9, 21, month=2)))
    last = max(b["batch_id"] for b in second)
    write_curated_batch(replay, last, cur)
    write_curated_batch(replay, last, cur)
    got = read_curated(spark, cur)
    assert got.where("month = 2").count() == 2
    assert got.where("month = 1 and day = 9").count() == 2


def test_incremental_aggregates_equal_full_rebuild(spark, make_raw, zones_df, scratch):
    raw, cur, ck = f"{scratch}/raw", f"{scratch}/cur", f"{scratch}/ck"
    out, ock = f"{scratch}/m", f"{scratch}/mck"
    land_raw(make_raw(trip(**day(9, 8)), trip(**day(10, 8))), raw, mode="dynamic")
    refresh_curated(spark, raw, cur, ck)
    refresh_aggregates(spark, cur, zones_df, out, ock)
    land_raw(make_raw(trip(**day(9, 20, month=2)), trip(**day(9, 9))), raw, mode="append")
    refresh_curated(spark, raw, cur, ck)
    refresh_aggregates(spark, cur, zones_df, out, ock)
    refresh_aggregates(spark, cur, zones_df, out, ock)  # nothing new
    z = spark.read.parquet(f"{out}/daily_zone")
    assert rows_of(z, "trip_date", "trip_count") == [
        (dt.date(2024, 1, 9), 2), (dt.date(2024, 1, 10), 1), (dt.date(2024, 2, 9), 1)]
    # Same as a full rebuild from the same curated rows.
    from tripmart.operators import marts

    for name, build in marts.MARTS.items():
        full = build(read_curated(spark, cur), zones_df)
        inc = spark.read.parquet(f"{out}/{name}")
        cols = list(full.columns)
        assert sorted(map(tuple, full.select(cols).collect())) == sorted(map(tuple, inc.select(cols).collect())), name


def test_append_mode_keeps_batches_separate(spark, make_raw, zones_df, scratch):
    raw, cur, ck = f"{scratch}/raw", f"{scratch}/cur", f"{scratch}/ck"
    out, ock = f"{scratch}/m", f"{scratch}/mck"
    land_raw(make_raw(trip(**day(9, 8))), raw, mode="dynamic")
    refresh_curated(spark, raw, cur, ck)
    refresh_aggregates(spark, cur, zones_df, out, ock, on_touch="append")
    land_raw(make_raw(trip(**day(9, 9))), raw, mode="append")
    refresh_curated(spark, raw, cur, ck)
    refresh_aggregates(spark, cur, zones_df, out, ock, on_touch="append")
    z = spark.read.parquet(f"{out}/daily_zone")
    # The source system's behaviour: one row per batch for the same grain.
    assert z.count() == 2 and z.agg(F.sum("trip_count")).first()[0] == 2


def test_new_checkpoint_on_old_output_is_refused(spark, make_raw, scratch):
    raw, cur = f"{scratch}/raw", f"{scratch}/cur"
    land_raw(make_raw(trip(**day(9))), raw)
    refresh_curated(spark, raw, cur, f"{scratch}/ck1")
    with pytest.raises(CheckpointMismatch):
        refresh_curated(spark, raw, cur, f"{scratch}/ck2")


def test_backfill_in_bounded_batches_equals_one_batch(spark, make_raw, scratch):
    raw = f"{scratch}/raw"
    rows = [trip(**day(d, month=m)) for m in (1, 2, 3) for d in (4, 5)]
    land_raw(make_raw(*rows), raw)
    small = refresh_curated(spark, raw, f"{scratch}/c1", f"{scratch}/k1", max_files_per_trigger=1)
    whole = refresh_curated(spark, raw, f"{scratch}/c2", f"{scratch}/k2")
    assert len(small) == 3 and len(whole) == 1
    a = read_curated(spark, f"{scratch}/c1").drop("processing_timestamp")
    b = read_curated(spark, f"{scratch}/c2").drop("processing_timestamp")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_full_and_month_jobs_read_the_incremental_layout(spark, make_raw, zones_df, scratch):
    raw, cur = f"{scratch}/raw", f"{scratch}/cur"
    land_raw(make_raw(trip(**day(4, month=1)), trip(**day(5, month=2))), raw)
    refresh_curated(spark, raw, cur, f"{scratch}/ck")
    assert "batch_id" not in scan_curated(spark, cur).columns
    rep = build_aggregates(spark, cur, zones_df, f"{scratch}/m")
    assert rep.input_rows == 2
    rep = build_aggregates(spark, cur, zones_df, f"{scratch}/m", 2024, 2)
    assert rep.input_rows == 1
    assert spark.read.parquet(f"{scratch}/m/daily_zone").count() == 2


def test_run_all_chains_both_steps_and_stops_at_first_failure(spark, make_raw, zones_df, scratch):
    from tripmart.plans.jobs import run_all

    land_raw(make_raw(trip(**day(4)), trip(**day(5)), trip(PULocationID=None)), f"{scratch}/raw")
    rep = run_all(spark, f"{scratch}/raw", zones_df, f"{scratch}/cur", f"{scratch}/m")
    assert rep["curate"].input_rows == 3 and rep["curate"].output_rows["curated_trips"] == 2
    assert rep["aggregate"].input_rows == 2
    assert rep["aggregate"].output_rows["daily_service"] == 2
    assert rep["aggregate"].pct("daily_service") == 100.0
    os.makedirs(f"{scratch}/empty")
    with pytest.raises(Exception):
        run_all(spark, f"{scratch}/empty", zones_df, f"{scratch}/cur2", f"{scratch}/m2")
    assert not os.path.exists(f"{scratch}/m2")


def test_landing_manifest_counts_files_and_bytes(spark, make_raw, scratch):
    from tripmart.sources.landing import landing_manifest
    from tripmart.sources.tables import scan_raw

    raw = f"{scratch}/raw"
    land_raw(make_raw(trip(**day(4)), trip(**day(5)), trip(**day(6, month=2))), raw)
    land_raw(make_raw(trip(**day(7))), raw, mode="append")  # a second January file
    rows = {(r.year, r.month): r for r in landing_manifest(scan_raw(spark, raw)).collect()}
    jan, feb = rows[(2024, 1)], rows[(2024, 2)]
    assert (jan.row_count, jan.file_count, feb.row_count, feb.file_count) == (3, 2, 1, 1)
    files = [f for f in os.listdir(f"{raw}/year=2024/month=1") if f.endswith(".parquet")]
    assert jan.total_bytes == sum(os.path.getsize(f"{raw}/year=2024/month=1/{f}") for f in files)
    assert jan.first_event == dt.datetime(2024, 1, 4, 10) and jan.last_event == dt.datetime(2024, 1, 7, 10)
