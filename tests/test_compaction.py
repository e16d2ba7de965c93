"""Compaction of curated batches: same rows, few files, nothing taken for new."""

from __future__ import annotations

import os

import pytest

from conftest import trip
from test_relanding import Lake, lake  # noqa: F401
from test_writes_and_streams import day, rows_of
from tripmart.sources.landing import land_raw
from tripmart.streaming.compaction import DayFiles, compact_curated, plan
from tripmart.streaming.incremental import RetractedInputError, read_curated, refresh_aggregates, refresh_curated


def day_files_of(root):
    found = {}
    for d, _, names in os.walk(root):
        if "/year=" in d and "/_" not in d[len(root):]:
            found.setdefault(d[d.index("/year="):], []).extend(n for n in names if n.endswith(".parquet"))
    return {k: len(v) for k, v in found.items() if v}


def many_batches(lake, make_raw, n):
    """n files of the same two days, each a batch of its own."""
    for i in range(n):
        make_raw(trip(**day(9, i)), trip(**day(10, i))).coalesce(1).write.mode("append").partitionBy("year", "month").parquet(lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck, max_files_per_trigger=1)


def test_many_batches_become_few_files(make_raw, lake):  # noqa: F811
    many_batches(lake, make_raw, 4)
    refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock)
    before = lake.curated()
    assert set(day_files_of(lake.cur).values()) == {4}
    assert compact_curated(lake.spark, lake.cur) == [2]
    assert set(day_files_of(lake.cur).values()) == {1} and lake.curated() == before
    # nothing fires: neither the marts nor the landing see anything new
    assert lake.run() == {"curate": [], "aggregate": []}
    lake.marts_equal_rebuild()
    assert compact_curated(lake.spark, lake.cur) == []
    # a late file touches its own day only, and a second compaction carries both states on
    land_raw(make_raw(trip(**day(9, 21))), lake.raw, mode="append")
    assert len(lake.run()["aggregate"]) == 1
    assert compact_curated(lake.spark, lake.cur, slack=1) == [1]
    assert lake.run() == {"curate": [], "aggregate": []}
    lake.marts_equal_rebuild()
    # rows of a compacted table are still taken back with their files
    land_raw(make_raw(trip(**day(10, 5))), lake.raw, mode="dynamic")
    lake.run()
    assert rows_of(read_curated(lake.spark, lake.cur), "day", "pickup_hour") == [(10, 5)]
    lake.marts_equal_rebuild()


def test_appended_marts_refuse_a_compacted_table(make_raw, lake):  # noqa: F811
    many_batches(lake, make_raw, 3)
    compact_curated(lake.spark, lake.cur)
    with pytest.raises(RetractedInputError):
        refresh_aggregates(lake.spark, lake.cur, lake.zones, lake.out, lake.ock, on_touch="append")


def test_plan_packs_days_by_size():
    def of(d, files, size):
        return DayFiles((2024, 1, d), files, size, d, ())

    days = [of(1, 50, 100), of(2, 2, 100), of(3, 9, 700), of(4, 60, 300), of(5, 200, 5000), of(6, 3, 1), of(7, 4, 150)]
    rounds = plan(days, target=100, round_bytes=1000)
    # days 2, 3 and 7 have no more files than their bytes need; day 5 fills a round beyond its bound
    assert [[d.day[2] for d in r] for r in rounds] == [[5], [4, 1, 6]]
    assert plan([], 100) == []
