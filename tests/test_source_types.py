"""Raw files in other types, the optional fee, table ownership, file-grain landing, the chained increments."""

from __future__ import annotations

import datetime as dt
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import trip
from tripmart.operators.enrich import check_zones, enrich_zones, sized_for_join
from tripmart.operators.curate import curate_trips
from tripmart.plans.jobs import TableOwnedError, build_aggregates, build_curated, run_all
from tripmart.sources.landing import files_to_land, land_raw
from tripmart.sources.tables import landed_schema, scan_curated, scan_raw
from tripmart.streaming.incremental import refresh_aggregates, refresh_all, refresh_curated


def other_types(raw):
    return raw.withColumns({
        "PULocationID": F.col("PULocationID").cast("bigint"),
        "DOLocationID": F.col("DOLocationID").cast("bigint"),
        "base_passenger_fare": F.col("base_passenger_fare").cast("decimal(10,2)"),
        "pickup_datetime": F.col("pickup_datetime").cast("string"),
    })


@pytest.mark.parametrize("incremental", [False, True])
def test_curate_reads_the_types_of_the_files(spark, make_raw, scratch, incremental):
    land_raw(other_types(make_raw(trip(), trip(base_passenger_fare=None))), f"{scratch}/raw")
    if incremental:
        refresh_curated(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ck")
    else:
        build_curated(spark, f"{scratch}/raw", f"{scratch}/out")
    rows = scan_curated(spark, f"{scratch}/out").orderBy("base_passenger_fare").collect()
    assert [(r.PULocationID, r.base_passenger_fare, r.day) for r in rows] == [(1, Decimal("0.00"), 15), (1, Decimal("20.00"), 15)]


@pytest.mark.parametrize("incremental", [False, True])
@pytest.mark.parametrize("present", [False, True])
def test_fee_is_read_through_the_jobs(spark, make_raw, scratch, incremental, present):
    raw = make_raw(trip())
    land_raw(raw.withColumn("cbd_congestion_fee", F.lit(1.5)) if present else raw, f"{scratch}/raw")
    if incremental:
        refresh_curated(spark, f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ck", use_cbd_fee=True)
    else:
        build_curated(spark, f"{scratch}/raw", f"{scratch}/out", use_cbd_fee=True)
    row = scan_curated(spark, f"{scratch}/out").first()
    fee = Decimal("1.50") if present else Decimal("0.00")
    assert row.cbd_congestion_fee == fee
    assert row.total_fare == Decimal("24.75") + fee


def test_empty_landing_has_the_declared_types(spark, scratch):
    os.makedirs(f"{scratch}/raw")
    assert scan_raw(spark, f"{scratch}/raw").count() == 0
    assert landed_schema(spark, f"{scratch}/raw")["PULocationID"].dataType.simpleString() == "int"


def test_a_curated_table_has_one_owner(spark, make_raw, scratch):
    land_raw(make_raw(trip()), f"{scratch}/raw")
    build_curated(spark, f"{scratch}/raw", f"{scratch}/full")
    with pytest.raises(TableOwnedError):
        refresh_curated(spark, f"{scratch}/raw", f"{scratch}/full", f"{scratch}/ck1")
    refresh_curated(spark, f"{scratch}/raw", f"{scratch}/inc", f"{scratch}/ck2")
    with pytest.raises(TableOwnedError):
        build_curated(spark, f"{scratch}/raw", f"{scratch}/inc")
    assert scan_curated(spark, f"{scratch}/inc").count() == 1


def test_null_zone_id_is_no_duplicate(spark, make_raw, zones_df):
    nulls = zones_df.unionByName(zones_df.limit(1).withColumn("LocationID", F.lit(None).cast("int")))
    assert check_zones(nulls) > check_zones(zones_df) > 0
    assert enrich_zones(curate_trips(make_raw(trip())), nulls).count() == 1


def test_broadcast_goes_by_bytes(zones_df):
    hinted = lambda df: "isBroadcastable" in df._jdf.queryExecution().logical().toString() or "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(sized_for_join(zones_df))
    assert not hinted(sized_for_join(zones_df, 1 << 40))


def test_half_landed_month_yields_its_other_files(spark, make_raw, scratch):
    land_raw(make_raw(trip()), f"{scratch}/src")
    land_raw(make_raw(trip(trip_miles=2.0)), f"{scratch}/more")
    month = "year=2024/month=1"
    for f in os.listdir(f"{scratch}/more/{month}"):
        if f.endswith(".parquet"):
            shutil.copy(f"{scratch}/more/{month}/{f}", f"{scratch}/src/{month}/{f}")
    first = next(f for f in sorted(os.listdir(f"{scratch}/src/{month}")) if f.endswith(".parquet"))
    os.makedirs(f"{scratch}/dst/{month}")
    shutil.copy(f"{scratch}/src/{month}/{first}", f"{scratch}/dst/{month}/{first}")
    src, dst = scan_raw(spark, f"{scratch}/src"), scan_raw(spark, f"{scratch}/dst")
    left = files_to_land(src, dst).collect()
    assert len(left) == 1 and left[0].file_name != first
    assert left[0].file_size == os.path.getsize(f"{scratch}/src/{month}/{left[0].file_name}")
    assert files_to_land(src, src).count() == 0


def test_chained_increments_agree_with_a_full_run(spark, make_raw, scratch, zones_df):
    places = (f"{scratch}/cur", f"{scratch}/cur-ck", f"{scratch}/marts", f"{scratch}/marts-ck")
    feb = dt.datetime(2024, 2, 3, 9, 0, 0)
    later = trip(year=2024, month=2, request_datetime=feb, pickup_datetime=feb, dropoff_datetime=feb + dt.timedelta(minutes=5))
    land_raw(make_raw(trip()), f"{scratch}/raw")
    refresh_all(spark, f"{scratch}/raw", zones_df, *places)
    land_raw(make_raw(later), f"{scratch}/raw", mode="append")
    refresh_all(spark, f"{scratch}/raw", zones_df, *places)
    run_all(spark, f"{scratch}/raw", zones_df, f"{scratch}/full", f"{scratch}/full-marts")
    for name in ("daily_borough", "daily_zone", "daily_service"):
        one, other = spark.read.parquet(f"{scratch}/marts/{name}"), spark.read.parquet(f"{scratch}/full-marts/{name}")
        assert one.count() == other.count() == 2
        assert one.select(other.columns).exceptAll(other).count() == 0


def test_marts_recover_after_a_replayed_curated_batch(spark, make_raw, scratch, zones_df, monkeypatch):
    """The first marts run fails before it writes; the curated batch is replayed; the retry must end well."""
    from tripmart.streaming import incremental

    land_raw(make_raw(trip()), f"{scratch}/raw")
    refresh_curated(spark, f"{scratch}/raw", f"{scratch}/cur", f"{scratch}/ck")
    real = incremental.write_table
    with monkeypatch.context() as m:
        m.setattr(incremental, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            refresh_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/marts", f"{scratch}/mck")
    assert incremental.write_table is real
    incremental.write_curated_batch(scan_raw(spark, f"{scratch}/raw"), 0, f"{scratch}/cur")
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    try:
        refresh_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/marts", f"{scratch}/mck")
        refresh_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/marts", f"{scratch}/mck")
    finally:
        spark.conf.unset("spark.sql.files.ignoreMissingFiles")
    for name in ("daily_borough", "daily_zone", "daily_service"):
        assert spark.read.parquet(f"{scratch}/marts/{name}").agg(F.sum("trip_count")).first()[0] == 1


def test_month_refresh_drops_vanished_days_of_every_mart(spark, make_raw, scratch, zones_df):
    def on(day):
        t = dt.datetime(2024, 2, day, 9, 0, 0)
        return trip(year=2024, month=2, request_datetime=t, pickup_datetime=t, dropoff_datetime=t + dt.timedelta(minutes=5))

    land_raw(make_raw(trip(), on(5), on(6)), f"{scratch}/raw")
    run_all(spark, f"{scratch}/raw", zones_df, f"{scratch}/cur", f"{scratch}/marts")
    land_raw(make_raw(trip(), on(6)), f"{scratch}/raw2")
    build_curated(spark, f"{scratch}/raw2", f"{scratch}/cur")
    build_aggregates(spark, f"{scratch}/cur", zones_df, f"{scratch}/marts", "2024", "02")
    for name in ("daily_borough", "daily_zone", "daily_service"):
        days = [r.trip_date.isoformat() for r in spark.read.parquet(f"{scratch}/marts/{name}").select("trip_date").orderBy("trip_date").collect()]
        assert days == ["2024-01-15", "2024-02-06"], name


def mixed_landing(make_raw, root):
    """Three months in three types: as declared; bigint ids and decimal money; times as text and int minutes."""
    from test_writes_and_streams import day

    first, second, third = (make_raw(trip(**day(4, month=m)), trip(PULocationID=None, **day(5, month=m))) for m in (1, 2, 3))
    ids = {c: F.col(c).cast("bigint") for c in ("PULocationID", "DOLocationID")}
    money = {c: F.col(c).cast("decimal(18,6)") for c in ("base_passenger_fare", "tips", "bcf", "airport_fee")}
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime")}
    land_raw(first, root)
    land_raw(second.withColumns({**ids, **money}), root, mode="dynamic")
    land_raw(third.withColumns({**times, "trip_time": F.col("trip_time").cast("int")}).drop("wav_match_flag"), root, mode="dynamic")


def test_files_of_different_types_are_one_landing(spark, make_raw, scratch, zones_df):
    from tripmart.sources.mixed import raw_scans
    from tripmart.streaming.incremental import read_curated

    mixed_landing(make_raw, f"{scratch}/raw")
    assert len(raw_scans(spark, f"{scratch}/raw")) == 3
    rep = build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    assert (rep.input_rows, rep.output_rows["curated_trips"]) == (6, 3)
    rows = scan_curated(spark, f"{scratch}/cur").drop("processing_timestamp", "month", "trip_date", *[f"{x}_datetime" for x in ("request", "on_scene", "pickup", "dropoff")])
    got = [tuple(r) for r in rows.drop("day_of_week", "is_weekend", "wav_match_flag").collect()]
    assert len(set(got)) == 1 and len(got) == 3
    assert [r.pickup_datetime.hour for r in scan_curated(spark, f"{scratch}/cur").collect()] == [10, 10, 10]
    # increments take the same files, batch by batch
    refresh_curated(spark, f"{scratch}/raw", f"{scratch}/inc", f"{scratch}/ck", max_files_per_trigger=2)
    same = [read_curated(spark, f"{scratch}/inc"), scan_curated(spark, f"{scratch}/cur")]
    assert len({tuple(sorted(map(str, d.drop("processing_timestamp").collect()))) for d in same}) == 1


def test_files_whose_types_merge_are_one_scan(spark, make_raw, scratch):
    from tripmart.sources.mixed import raw_scans

    land_raw(make_raw(trip()), f"{scratch}/raw")
    land_raw(make_raw(trip()).drop("wav_match_flag").withColumn("cbd_congestion_fee", F.lit(0.75)), f"{scratch}/raw", mode="append")
    (scan,) = raw_scans(spark, f"{scratch}/raw")
    assert scan.count() == 2 and scan.where("wav_match_flag is null").count() == 1
