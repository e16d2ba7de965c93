"""Physical-plan checks: pushdown, pruning, broadcast, no Python in the plan."""

from __future__ import annotations

import datetime as dt

from conftest import SF_SMALL, trip
from tripmart import queries as Q
from tripmart.operators import marts
from tripmart.operators.quality import validate_trips
from tripmart.operators.curate import curate_trips
from tripmart.plans.jobs import build_curated
from tripmart.sources.landing import land_raw
from tripmart.sources.tables import scan_curated, scan_raw


def plan_of(df) -> str:
    df._jdf.queryExecution().executedPlan()  # force planning
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def no_python(plan: str) -> bool:
    return "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_validation_filters_reach_the_raw_scan(spark, make_raw, scratch):
    t = dt.datetime(2024, 1, 15, 10, 5)
    land_raw(make_raw(trip(pickup_datetime=t)), f"{scratch}/raw")
    plan = plan_of(validate_trips(curate_trips(scan_raw(spark, f"{scratch}/raw"))))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    for f in ("IsNotNull(pickup_datetime)", "IsNotNull(dropoff_datetime)", "IsNotNull(PULocationID)",
              "IsNotNull(DOLocationID)", "IsNotNull(request_datetime)",
              "In(hvfhs_license_num, [HV0002,HV0003,HV0004,HV0005])"):
        assert f in pushed
    assert no_python(plan)


def test_marts_read_only_needed_columns_and_broadcast_zones(spark, make_raw, zones_df, scratch):
    land_raw(make_raw(trip()), f"{scratch}/raw")
    build_curated(spark, f"{scratch}/raw", f"{scratch}/cur")
    cur = scan_curated(spark, f"{scratch}/cur")
    borough = plan_of(marts.daily_borough(cur, zones_df))
    read = [line for line in borough.splitlines() if "ReadSchema" in line and "trip_miles" in line][0]
    assert "driver_pay" not in read and "hvfhs_license_num" not in read
    assert "BroadcastHashJoin" in borough and "SortMergeJoin" not in borough
    assert borough.count("Arguments: hashpartitioning(") == 1  # one shuffle, by borough pair
    service = plan_of(marts.daily_service(cur))
    assert "Join" not in service  # the service mart needs no zone
    zone = plan_of(marts.daily_zone(cur, zones_df))
    assert "BroadcastHashJoin" in zone and no_python(zone)


def test_registered_marts_have_no_python_and_one_shuffle_per_aggregate(spark):
    plan = plan_of(Q.q_daily_service(spark, SF_SMALL))
    assert no_python(plan)
    assert plan.count("Arguments: hashpartitioning(trip_date") == 1


def test_latest_month_slice_prunes_partitions(spark, make_raw, scratch):
    rows = [trip(year=2024, month=m, pickup_datetime=dt.datetime(2024, m, 3, 9)) for m in (1, 2, 3)]
    land_raw(make_raw(*rows), f"{scratch}/raw")
    from tripmart.sources.landing import slice_current, slice_historical

    raw = scan_raw(spark, f"{scratch}/raw")
    cur = slice_current(raw)
    assert "PartitionFilters: [isnotnull(year" in plan_of(cur)
    assert [(r.year, r.month) for r in cur.collect()] == [(2024, 3)]
    hist = sorted((r.year, r.month) for r in slice_historical(raw, 2024).collect())
    assert hist == [(2024, 1), (2024, 2)]


def test_zone_roles_share_one_broadcast(spark):
    df = Q.q_daily_zone(spark, SF_SMALL)
    df.collect()  # the adaptive plan is final once it has run
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final or "Final Plan" in final
    assert "ReusedExchange" in final
    assert "SortMergeJoin" not in final
