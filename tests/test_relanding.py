"""Increments over landings that change, mixed modes on one marts root, and publishing at once."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import trip
from test_writes_and_streams import day, rows_of
from tripmart.operators import marts
from tripmart.plans import jobs
from tripmart.plans.jobs import EmptyInputError, TableOwnedError, build_aggregates
from tripmart.sinks import publish
from tripmart.sinks.publish import Publication, PublishConflict, is_published, recover
from tripmart.sources.landing import land_raw
from tripmart.sources.ledger import live_files
from tripmart.streaming import incremental
from tripmart.streaming.incremental import RetractedInputError, append_batch, read_appended, read_curated, refresh_aggregates, refresh_all, refresh_curated


class Lake:
    """Roots of one landing, its curated table and its marts."""

    def __init__(self, spark, zones, root):
        self.spark, self.zones = spark, zones
        self.raw, self.cur, self.ck, self.out, self.ock = (f"{root}/{n}" for n in ("raw", "cur", "ck", "m", "mck"))

    def run(self):
        return refresh_all(self.spark, self.raw, self.zones, self.cur, self.ck, self.out, self.ock)

    def curated(self):
        return sorted(map(str, read_curated(self.spark, self.cur).drop("processing_timestamp").collect()))

    def marts_equal_rebuild(self):
        trips = read_curated(self.spark, self.cur)
        for name, build in marts.MARTS.items():
            full = build(trips, self.zones)
            got = self.spark.read.schema(full.schema).parquet(f"{self.out}/{name}")
            assert sorted(map(str, full.collect())) == sorted(map(str, got.select(full.columns).collect())), name


@pytest.fixture
def lake(spark, zones_df, scratch):
    return Lake(spark, zones_df, scratch)


def test_a_month_landed_again_replaces_its_trips(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(10)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    # January again: day 10 is gone, day 9 has another hour, day 12 is new
    land_raw(make_raw(trip(**day(9, 7)), trip(**day(12))), lake.raw, mode="dynamic")
    lake.run()
    got = read_curated(lake.spark, lake.cur)
    assert rows_of(got, "trip_date", "pickup_hour") == [(dt.date(2024, 1, 9), 7), (dt.date(2024, 1, 12), 10), (dt.date(2024, 2, 5), 10)]
    lake.marts_equal_rebuild()
    zone = lake.spark.read.parquet(f"{lake.out}/daily_zone")
    assert rows_of(zone, "trip_date", "trip_count") == [(dt.date(2024, 1, 9), 1), (dt.date(2024, 1, 12), 1), (dt.date(2024, 2, 5), 1)]
    assert lake.run() == {"curate": [], "aggregate": []}


def test_a_month_landed_again_unchanged_is_not_doubled(make_raw, lake):
    rows = make_raw(trip(**day(9)), trip(**day(10)))
    land_raw(rows, lake.raw)
    lake.run()
    before = lake.curated()
    land_raw(rows, lake.raw, mode="dynamic")
    lake.run()
    assert lake.curated() == before
    lake.marts_equal_rebuild()


def test_a_month_taken_away_leaves_curated_and_marts(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    shutil.rmtree(f"{lake.raw}/year=2024/month=1")
    lake.run()
    assert rows_of(read_curated(lake.spark, lake.cur), "month") == [(2,)]
    lake.marts_equal_rebuild()
    assert rows_of(lake.spark.read.parquet(f"{lake.out}/daily_borough"), "month") == [(2,)]


def test_a_file_replaced_under_its_name_is_taken_in_again(make_raw, lake, scratch):
    """The stream knows the name and passes the file over; the ledger knows its contents changed."""
    land_raw(make_raw(trip(**day(9)), trip(**day(9, 11))), lake.raw)
    lake.run()
    folder = f"{lake.raw}/year=2024/month=1"
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    land_raw(make_raw(trip(**day(9, 13)), trip(**day(20)), trip(**day(21))), f"{scratch}/other")
    other = f"{scratch}/other/year=2024/month=1"
    shutil.copyfile(f"{other}/{next(f for f in os.listdir(other) if f.endswith('.parquet'))}", f"{folder}/{name}")
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    reports = lake.run()["curate"]
    assert [r["input_rows"] for r in reports] == [3]
    assert rows_of(read_curated(lake.spark, lake.cur), "day", "pickup_hour") == [(9, 13), (20, 10), (21, 10)]
    lake.marts_equal_rebuild()
    assert lake.run() == {"curate": [], "aggregate": []}


def test_only_days_with_rows_of_a_gone_file_are_written_again(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(10)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    feb = f"{lake.cur}/batch_id=0/year=2024/month=2/day=5"
    before = {f: os.stat(f"{feb}/{f}").st_mtime_ns for f in os.listdir(feb)}
    land_raw(make_raw(trip(**day(9))), lake.raw, mode="dynamic")
    lake.run()
    assert {f: os.stat(f"{feb}/{f}").st_mtime_ns for f in os.listdir(feb)} == before
    assert not os.path.exists(f"{lake.cur}/batch_id=0/year=2024/month=1/day=10")
    live = {(r.path.rsplit("/", 2)[-2], r.batch_id) for r in live_files(lake.spark, lake.cur).collect()}
    assert live == {("month=1", 1), ("month=2", 0)}


def test_a_cut_short_correction_is_done_by_the_next_run(make_raw, lake, monkeypatch):
    land_raw(make_raw(trip(**day(9)), trip(**day(10))), lake.raw)
    lake.run()
    before = lake.curated()
    land_raw(make_raw(trip(**day(9))), lake.raw, mode="dynamic")
    monkeypatch.setattr(incremental, "_publish_entries", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError, match="stop"):
        refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    assert lake.curated() == before
    monkeypatch.undo()
    lake.run()
    assert rows_of(read_curated(lake.spark, lake.cur), "day") == [(9,)]
    lake.marts_equal_rebuild()


def test_an_old_table_without_ledger_is_refused(make_raw, lake):
    land_raw(make_raw(trip(**day(9))), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    shutil.rmtree(f"{lake.cur}/_ledger")
    with pytest.raises(TableOwnedError, match="ledger"):
        refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)


# -- full, monthly and incremental runs on one marts root -----------------------------------------


def drop_day(lake, d):
    """A day's trips are taken out of the curated table by other means."""
    for b in os.listdir(lake.cur):
        shutil.rmtree(f"{lake.cur}/{b}/year=2024/month=1/day={d}", ignore_errors=True)


def test_an_increment_after_a_month_refresh_keeps_it(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(10))), lake.raw)
    lake.run()
    drop_day(lake, 9)
    build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, 2024, 1)
    lake.marts_equal_rebuild()
    land_raw(make_raw(trip(**day(11))), lake.raw, mode="append")
    lake.run()
    lake.marts_equal_rebuild()
    assert rows_of(lake.spark.read.parquet(f"{lake.out}/daily_service"), "trip_date") == [(dt.date(2024, 1, 10),), (dt.date(2024, 1, 11),)]


def test_increments_may_follow_a_full_build(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(10))), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    build_aggregates(lake.spark, lake.cur, lake.zones, lake.out)
    drop_day(lake, 9)  # before the first increment knows of it
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock)
    lake.marts_equal_rebuild()
    assert refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock) == []


def test_marts_made_from_given_rows_are_made_again(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(10)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    other = read_curated(lake.spark, lake.cur).where("month = 1").withColumn("trip_date", F.to_date(F.lit("2024-01-20")))
    build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, 2024, 1, curated=other)
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock)
    lake.marts_equal_rebuild()


def test_marts_of_another_curated_table_are_refused(make_raw, lake, scratch):
    land_raw(make_raw(trip(**day(9))), lake.raw)
    lake.run()
    refresh_curated(lake.spark, lake.raw, f"{scratch}/cur2", f"{scratch}/ck2")
    with pytest.raises(TableOwnedError):
        refresh_aggregates(lake.spark, f"{scratch}/cur2", lake.zones, lake.out, f"{scratch}/mck2")
    with pytest.raises(TableOwnedError):
        build_aggregates(lake.spark, f"{scratch}/cur2", lake.zones, lake.out, 2024, 1)


def test_only_stale_days_are_read(make_raw, lake, monkeypatch):
    land_raw(make_raw(trip(**day(9)), trip(**day(10)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    land_raw(make_raw(trip(**day(10, 20))), lake.raw, mode="append")
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    made = []
    whole = incremental._recompute_days
    monkeypatch.setattr(incremental, "_recompute_days", lambda *a: made.append(a[6]) or whole(*a))
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock)
    assert made == [[(2024, 1, 10)]]
    lake.marts_equal_rebuild()


def test_days_in_several_rounds_equal_one(make_raw, lake):
    land_raw(make_raw(*[trip(**day(d)) for d in range(1, 8)]), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    assert len(refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, max_days=3)) == 3
    lake.marts_equal_rebuild()


def test_a_month_without_trips_is_an_error_or_leaves_the_marts(make_raw, lake):
    land_raw(make_raw(trip(**day(9)), trip(**day(5, month=2))), lake.raw)
    lake.run()
    drop_day(lake, 9)
    with pytest.raises(EmptyInputError):
        build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, 2024, "01")
    build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, 2024, "01", on_empty="drop")
    lake.marts_equal_rebuild()
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock)
    lake.marts_equal_rebuild()


# -- publishing at once ---------------------------------------------------------------------------


def snapshot(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("month", [None, 1])
def test_a_job_that_fails_between_marts_leaves_all_as_before(make_raw, lake, monkeypatch, month):
    land_raw(make_raw(trip(**day(9)), trip(**day(10))), lake.raw)
    lake.run()
    before = snapshot(lake.out)
    land_raw(make_raw(trip(**day(12))), lake.raw, mode="append")
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    calls, whole = [], publish.write_table

    def second_fails(df, path, *a, **k):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("disk full")
        whole(df, path, *a, **k)

    monkeypatch.setattr(publish, "write_table", second_fails)
    target = (2024, month) if month else ()
    with pytest.raises(OSError, match="disk full"):
        build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, *target)
    assert len(calls) == 2 and snapshot(lake.out) == before
    monkeypatch.undo()
    build_aggregates(lake.spark, lake.cur, lake.zones, lake.out, *target)
    lake.marts_equal_rebuild()


@pytest.mark.parametrize("done", range(6))
def test_a_commit_cut_short_is_finished_by_the_next_job(spark, scratch, monkeypatch, done):
    """Stopped after any of its moves, a committed publication is whole once it is recovered."""
    frame = lambda v: spark.createDataFrame([(v, d) for d in (1, 2, 3)], "v int, day int")
    with Publication(spark, scratch) as pub:
        pub.write(frame(1), "a", ["day"], mode="dynamic")
        pub.write(frame(1), "b")
        pub.commit()
    moves, whole = [], publish.move

    def stops(*a):
        if len(moves) == done:
            raise KeyboardInterrupt
        moves.append(a)
        whole(*a)

    monkeypatch.setattr(publish, "move", stops)
    with pytest.raises(KeyboardInterrupt), Publication(spark, scratch, key="k") as pub:
        pub.write(frame(2).where("day < 3"), "a", ["day"], mode="dynamic")
        pub.drop("a", ["day=2", "day=3"])
        pub.write(frame(2), "b")
        pub.commit()
    monkeypatch.undo()
    recover(spark, scratch)
    assert is_published(spark, scratch, "k")
    assert rows_of(spark.read.parquet(f"{scratch}/a"), "day", "v") == [(1, 2), (2, 2)]
    assert rows_of(spark.read.parquet(f"{scratch}/b"), "day", "v") == [(1, 2), (2, 2), (3, 2)]
    assert os.listdir(f"{scratch}/_staged") == []


def test_of_two_jobs_that_meet_one_is_refused(spark, scratch):
    frame = spark.range(3)
    with Publication(spark, scratch) as one:
        one.write(frame, "t")
        with pytest.raises(PublishConflict), Publication(spark, scratch) as two:
            two.write(frame.where("id > 0"), "t")
            one.commit()
            two.commit()
    assert spark.read.parquet(f"{scratch}/t").count() == 3 and os.listdir(f"{scratch}/_staged") == []


# -- append exactly once --------------------------------------------------------------------------


def test_a_replayed_append_adds_nothing(make_raw, lake):
    land_raw(make_raw(trip(**day(9))), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")
    before = snapshot(lake.out)
    # the stream forgets that batch 0 was done, as after a failure before its own commit
    shutil.rmtree(f"{lake.ock}/commits")
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")
    assert snapshot(lake.out) == before


def test_a_day_split_over_appended_batches_has_one_row_a_grain_on_read(make_raw, lake):
    for hour, miles in ((8, 1.0), (9, 2.0), (10, 2.0)):
        land_raw(make_raw(trip(trip_miles=miles, **day(9, hour))), lake.raw, mode="append")
        refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
        refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")
    assert lake.spark.read.parquet(f"{lake.out}/daily_zone").count() == 3
    trips = read_curated(lake.spark, lake.cur)
    for name, table in read_appended(lake.spark, lake.out, lake.zones).items():
        full = marts.MARTS[name](trips, lake.zones)
        assert sorted(map(str, table.select(full.columns).collect())) == sorted(map(str, full.collect())), name


def test_an_append_that_fails_between_marts_adds_nothing(make_raw, lake, monkeypatch):
    from tripmart.operators.curate import curate_trips

    trips = curate_trips(make_raw(trip(**day(9))))
    calls, whole = [], publish.write_table

    def third_fails(df, path, *a, **k):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("disk full")
        whole(df, path, *a, **k)

    monkeypatch.setattr(publish, "write_table", third_fails)
    with pytest.raises(OSError):
        append_batch(trips, "b0", lake.zones, None, lake.out)
    assert snapshot(lake.out) == []
    monkeypatch.undo()
    assert append_batch(trips, "b0", lake.zones, None, lake.out) and not append_batch(trips, "b0", lake.zones, None, lake.out)
    assert lake.spark.read.parquet(f"{lake.out}/daily_zone").count() == 1


def test_appended_marts_refuse_rows_taken_back(make_raw, lake):
    land_raw(make_raw(trip(**day(9))), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")
    land_raw(make_raw(trip(**day(9, 7))), lake.raw, mode="dynamic")
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    with pytest.raises(RetractedInputError):
        refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")


def test_jobs_name_the_partials_folder_once():
    assert incremental.CUBE_DIR is jobs.CUBE_DIR
