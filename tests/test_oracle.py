"""Registered queries against their DuckDB oracle SQL on the smallest test tables.

Read-only queries run here; the ones that write tables are covered by
scripts/oracle_check.py and by the write/stream tests.
"""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry

WRITES = {
    "scan_raw_trips", "scan_target_month", "scan_zone_lookup", "scan_catalog_table",
    "roundtrip_curated_overwrite", "roundtrip_borough_overwrite", "roundtrip_append",
    "target_month_refresh", "curated_trips", "incremental_curate", "incremental_aggregate",
    "latest_month", "slice_current", "slice_historical", "new_partitions_only", "landing_manifest",
    "target_month_refresh_zone", "target_month_refresh_service",
    "incremental_aggregate_zone", "incremental_aggregate_service",
    "chained_run_borough", "chained_run_zone", "chained_run_service", "pipeline_summary", "curated_other_types",
    "relanded_curate", "refresh_then_increment_borough", "refresh_then_increment_zone", "refresh_then_increment_service",
    "files_to_land", "profile_by_day", "curated_mixed_types", "partition_discovery", "written_compression", "processing_stamp", "empty_input",
}
TABLES = ["region", "nation", "lineitem"]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(set(entry.oracle_sql()) - WRITES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in rel.columns)
    assert canon(df.columns, df.collect()) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["trip_date", "day_of_week", "is_weekend", "pickup_borough", "dropoff_borough"]
