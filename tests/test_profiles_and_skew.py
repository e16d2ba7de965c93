"""Profiles kept by day, counts from footers, digests of files' contents, and joins to large zone tables."""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import trip
from test_relanding import Lake, lake  # noqa: F401
from test_writes_and_streams import day
from tripmart.operators import enrich
from tripmart.operators.curate import curate_trips
from tripmart.operators.reports import profile, row_summary
from tripmart.operators.skew import frequent_keys
from tripmart.sources.landing import files_to_land, land_raw
from tripmart.sources.tables import metadata_session, scan_curated, scan_raw
from tripmart.streaming import profiles
from tripmart.streaming.incremental import read_curated, refresh_curated


def test_a_profile_by_day_reads_the_days_that_changed(make_raw, lake, scratch):  # noqa: F811
    land_raw(make_raw(trip(**day(9)), trip(tips=None, **day(10)), trip(**day(5, month=2))), lake.raw)
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    assert len(profiles.refresh_profile(lake.spark, lake.cur, f"{scratch}/p")) == 3
    # January again, without day 10 and with a new extreme
    land_raw(make_raw(trip(**day(9)), trip(trip_miles=499.0, **day(12))), lake.raw, mode="dynamic")
    refresh_curated(lake.spark, lake.raw, lake.cur, lake.ck)
    assert profiles.refresh_profile(lake.spark, lake.cur, f"{scratch}/p") == [(2024, 1, 9), (2024, 1, 10), (2024, 1, 12)]
    assert profiles.refresh_profile(lake.spark, lake.cur, f"{scratch}/p") == []
    want = profile(read_curated(lake.spark, lake.cur).drop("processing_timestamp"))
    assert sorted(map(str, profiles.read_profile(lake.spark, f"{scratch}/p").collect())) == sorted(map(str, want.collect()))


def test_rows_are_counted_from_footers(spark, make_raw, scratch):
    from tripmart.schemas import CURATED_PARTITIONS
    from tripmart.sinks import write_table

    rows = curate_trips(make_raw(*[trip(**day(d)) for d in range(1, 6)]))
    write_table(rows, f"{scratch}/c", CURATED_PARTITIONS)
    footers = metadata_session(spark)
    counts = row_summary(scan_curated(footers, f"{scratch}/c"), {"curated_trips": scan_curated(footers, f"{scratch}/c")})
    assert [tuple(map(str, r)) for r in counts.collect()] == [("curated_trips", "5", "100.0000")]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "COUNT(*)" in plan[plan.index("PushedAggregat"):] and "pickup" not in plan
    # the settings stay with their session
    assert "PushedAggregat" not in scan_curated(spark, f"{scratch}/c").agg(F.count(F.lit(1)))._jdf.queryExecution().toString()


def test_a_file_published_again_with_other_rows_is_offered_again(spark, make_raw, scratch):
    source, landed = f"{scratch}/src", f"{scratch}/dst"
    rows = [trip(**day(4)), trip(**day(5)), trip(**day(5))]
    land_raw(make_raw(*rows), source)
    land_raw(make_raw(*rows[::-1]), landed)

    def file_in(root):
        folder = f"{root}/year=2024/month=1"
        return next(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet"))

    def offered(by):
        return files_to_land(scan_raw(spark, source), scan_raw(spark, landed), by).count()

    # the same rows in another order, under another name
    assert (offered("name"), offered("content"), offered("both")) == (1, 0, 1)
    os.remove(os.path.join(os.path.dirname(file_in(landed)), f".{os.path.basename(file_in(landed))}.crc"))
    os.rename(file_in(landed), os.path.join(os.path.dirname(file_in(landed)), os.path.basename(file_in(source))))
    assert (offered("name"), offered("content"), offered("both")) == (0, 0, 0)
    # under the same name, one row more often and another less
    name = os.path.basename(file_in(source))
    land_raw(make_raw(trip(**day(4)), trip(**day(4)), trip(**day(5))), source)
    os.remove(os.path.join(os.path.dirname(file_in(source)), f".{os.path.basename(file_in(source))}.crc"))
    os.rename(file_in(source), os.path.join(os.path.dirname(file_in(source)), name))
    assert (offered("name"), offered("content"), offered("both")) == (0, 1, 1)


@pytest.fixture
def plain_shuffles(spark):
    """AQE off and 16 partitions: what is asked for is what runs."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_zone_table_over_the_bound_and_one_id_on_half_the_trips(plain_shuffles, make_raw, monkeypatch):
    spark = plain_shuffles
    example = curate_trips(make_raw(trip()))
    zones = spark.range(2000).select(F.col("id").cast("int").alias("LocationID"), F.format_string("b%d", F.col("id") % 7).alias("Borough"),
                                     F.format_string("z%d", "id").alias("Zone"), F.lit("s").alias("service_zone"))
    pickup = F.when(F.col("id") % 2 == 0, 42).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 2500).cast("int")
    ids = spark.range(24000).repartition(8).select(pickup.alias("p"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2100).cast("int").alias("d"))
    trips = ids.crossJoin(F.broadcast(example)).withColumns({"PULocationID": F.col("p"), "DOLocationID": F.col("d")}).drop("p", "d")
    want = Counter(map(tuple, enrich.enrich_zones(trips, zones).collect()))
    monkeypatch.setattr(enrich, "BROADCAST_MAX_BYTES", 0)
    got = enrich.enrich_zones(trips, zones)
    rows = got.withColumn("part", F.spark_partition_id()).collect()
    assert Counter(tuple(r)[:-1] for r in rows) == want
    sizes = list(Counter(r.part for r in rows).values())
    assert len(sizes) == 16 and max(sizes) < 2 * np.median(sizes)
    assert frequent_keys(trips, ["PULocationID", "DOLocationID"]) == {"PULocationID": [42], "DOLocationID": [7]}
