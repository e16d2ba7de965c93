"""Independent DuckDB SQL for every registered query.

Written from the specification (FIXTURES.md), not from the Spark code: the
same raw-trip mapping, curation, rules and marts, in DuckDB's dialect,
over the pre-registered test tables.  DuckDB rounds differently from
Spark in two places, so these helpers reproduce Spark's results:

* double -> decimal(10,2): Spark rounds the shortest decimal text of the
  double HALF_UP, so the oracle casts through VARCHAR;
* avg(decimal(10,2)) -> decimal(10,2): Spark rounds HALF_UP to 6 places,
  then HALF_UP to 2; the oracle does the same on integer cents.
"""

from __future__ import annotations

FARE_CHARGES = [
    "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee",
]
MONEY8 = [*FARE_CHARGES, "tips", "driver_pay"]
FLAGS = [
    "shared_request_flag", "shared_match_flag", "access_a_ride_flag",
    "wav_request_flag", "wav_match_flag",
]
TS = ["request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime"]


def dec(expr: str, p: int = 10, s: int = 2) -> str:
    return f"TRY_CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL({p},{s}))"


def amt(c: str) -> str:
    return f"coalesce({c}, 0.0::DOUBLE)"


def avg2(c: str) -> str:
    """Spark's cast(avg(decimal(10,2)) as decimal(10,2)), in cents, HALF_UP twice."""
    s = f"CAST(sum({c}) * 100 AS HUGEINT)"
    n = f"count({c})"
    cents = f"sign({s}) * ((((2 * abs({s}) * 10000 + {n}) // (2 * {n})) + 5000) // 10000)"
    return f"TRY_CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS DECIMAL(10,2))"


def tot(c: str) -> str:
    return f"TRY_CAST(sum({c}) AS DECIMAL(12,2))"


FARE_SUM = " + ".join([amt(c) for c in FARE_CHARGES] + ["0.0::DOUBLE"])

RAW_CTE = f"""
raw_base AS (
  SELECT *,
    l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) AS pk,
    CAST(CASE WHEN l_orderkey % 41 = 0 THEN 0 ELSE l_quantity * 61 + l_linenumber * 7 END AS BIGINT) AS tt
  FROM lineitem
),
raw_trips AS (
  SELECT
    CASE WHEN l_partkey % 40 = 0 THEN 'HV0001' WHEN l_partkey % 40 = 1 THEN NULL
         ELSE concat('HV000', CAST(2 + l_partkey % 4 AS VARCHAR)) END AS hvfhs_license_num,
    concat('B', CAST(l_suppkey AS VARCHAR)) AS dispatching_base_num,
    CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE concat('B', CAST(l_suppkey AS VARCHAR)) END AS originating_base_num,
    CASE WHEN l_orderkey % 47 = 0 THEN NULL
         WHEN l_orderkey % 53 = 0 THEN pk + to_seconds(30)
         WHEN l_orderkey % 59 = 0 THEN pk
         ELSE pk + to_seconds(-(1 + l_orderkey % 600)) END AS request_datetime,
    CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE pk + to_seconds(-(l_orderkey % 60)) END AS on_scene_datetime,
    CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE pk END AS pickup_datetime,
    CASE WHEN l_orderkey % 67 = 0 THEN NULL ELSE pk + to_seconds(tt) END AS dropoff_datetime,
    CAST(CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_suppkey % 27 END AS INTEGER) AS PULocationID,
    CAST(CASE WHEN l_partkey % 73 = 0 THEN NULL ELSE l_partkey % 26 END AS INTEGER) AS DOLocationID,
    CASE WHEN l_partkey % 29 = 0 THEN NULL
         WHEN l_orderkey % 79 = 0 THEN -1.5::DOUBLE
         WHEN l_orderkey % 83 = 0 THEN 500.004::DOUBLE
         WHEN l_orderkey % 89 = 0 THEN 500.01::DOUBLE
         ELSE l_partkey / 64.0::DOUBLE END AS trip_miles,
    tt AS trip_time,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         WHEN l_orderkey % 101 = 0 THEN -l_extendedprice
         ELSE l_extendedprice / 10.0::DOUBLE END AS base_passenger_fare,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax * 100 END AS tolls,
    l_tax AS bcf,
    l_tax * 3 AS sales_tax,
    CASE WHEN l_partkey % 2 = 0 THEN 2.75::DOUBLE ELSE 0.0::DOUBLE END AS congestion_surcharge,
    CASE WHEN l_partkey % 10 = 0 THEN 2.5::DOUBLE WHEN l_partkey % 10 = 1 THEN NULL
         ELSE 0.0::DOUBLE END AS airport_fee,
    l_discount * 10 AS tips,
    l_extendedprice * 0.07::DOUBLE AS driver_pay,
    CASE WHEN l_returnflag = 'A' THEN 'Y' WHEN l_returnflag = 'N' THEN 'N' END AS shared_request_flag,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS shared_match_flag,
    ' ' AS access_a_ride_flag,
    CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS wav_request_flag,
    CASE WHEN l_linestatus = 'O' AND l_partkey % 3 = 0 THEN 'Y' WHEN l_partkey % 3 = 1 THEN 'y'
         ELSE 'N' END AS wav_match_flag,
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month
  FROM raw_base
)"""

METRICS = {
    "trip_duration_minutes": dec("trip_time / 60.0::DOUBLE"),
    "total_fare": dec(FARE_SUM),
    "total_amount": dec(FARE_SUM + " + " + amt("tips")),
    "avg_speed_mph": dec("CASE WHEN trip_time > 0 THEN trip_miles / (trip_time / 3600.0::DOUBLE) END"),
    "is_airport_trip": "coalesce(airport_fee, 0.0::DOUBLE) > 0",
}

CURATED_CTE = f"""
curated AS (
  SELECT hvfhs_license_num, dispatching_base_num, originating_base_num,
    {", ".join(TS)},
    PULocationID, DOLocationID,
    {dec(amt("trip_miles"))} AS trip_miles,
    TRY_CAST(trip_time AS INTEGER) AS trip_time_seconds,
    {", ".join(f"{dec(amt(c))} AS {c}" for c in MONEY8)},
    {", ".join(f"coalesce({c} = 'Y', false) AS {c}" for c in FLAGS)},
    CAST(0 AS DECIMAL(10,2)) AS cbd_congestion_fee,
    CAST(pickup_datetime AS DATE) AS trip_date,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    coalesce(dayname(pickup_datetime), 'Unknown') AS day_of_week,
    coalesce(dayofweek(pickup_datetime) IN (0, 6), false) AS is_weekend,
    {", ".join(f"{e} AS {n}" for n, e in METRICS.items())},
    CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month,
    CAST(day(pickup_datetime) AS INTEGER) AS day
  FROM raw_trips
)"""

RULES = {
    "pickup_not_null": "pickup_datetime IS NOT NULL",
    "dropoff_not_null": "dropoff_datetime IS NOT NULL",
    "pu_location_not_null": "PULocationID IS NOT NULL",
    "do_location_not_null": "DOLocationID IS NOT NULL",
    "miles_min": "trip_miles >= 0",
    "miles_max": "trip_miles <= 500",
    "fare_min": "base_passenger_fare >= 0",
    "fare_max": "base_passenger_fare <= 10000",
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "pickup_not_before_request": "pickup_datetime >= request_datetime",
    "license_known": "hvfhs_license_num IN ('HV0002', 'HV0003', 'HV0004', 'HV0005')",
}
ALL_RULES = " AND ".join(f"({r})" for r in RULES.values())

VALID_CTE = f"""
valid AS (SELECT * FROM curated WHERE {ALL_RULES})"""

ZONES_CTE = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
    CASE WHEN n_nationkey % 3 = 0 THEN 'Yellow Zone' WHEN n_nationkey % 3 = 1 THEN 'Boro Zone'
         ELSE 'Airports' END AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

ENRICHED_CTE = """
enriched AS (
  SELECT v.trip_date, v.day_of_week, v.is_weekend, v.PULocationID, v.DOLocationID,
    v.shared_request_flag, v.shared_match_flag, v.wav_request_flag, v.wav_match_flag,
    v.is_airport_trip, v.total_amount, v.trip_miles, v.trip_duration_minutes, v.driver_pay,
    pz.Borough AS pickup_borough, pz.Zone AS pickup_zone, pz.service_zone AS pickup_service_zone,
    dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone
  FROM valid v
  LEFT JOIN zones pz ON v.PULocationID = pz.LocationID
  LEFT JOIN zones dz ON v.DOLocationID = dz.LocationID
)"""

DATE_PARTS = {
    "year": "CAST(year(trip_date) AS INTEGER)",
    "month": "CAST(month(trip_date) AS INTEGER)",
    "day": "CAST(day(trip_date) AS INTEGER)",
}


def parts(*names: str) -> str:
    return ", ".join(f"{DATE_PARTS[n]} AS {n}" for n in names)


BOROUGH_SELECT = f"""
  SELECT trip_date, day_of_week, is_weekend, pickup_borough, dropoff_borough,
    count(*) AS trip_count,
    {tot("total_amount")} AS total_revenue,
    {tot("trip_miles")} AS total_distance,
    CAST(trunc(sum(trip_duration_minutes)) AS BIGINT) AS total_duration,
    {avg2("trip_miles")} AS avg_borough_distance,
    {avg2("trip_duration_minutes")} AS avg_borough_duration,
    {parts("year", "month")}
  FROM enriched
  GROUP BY trip_date, day_of_week, is_weekend, pickup_borough, dropoff_borough"""

ZONE_NAMES = [
    "pickup_zone", "pickup_borough", "pickup_service_zone",
    "dropoff_zone", "dropoff_borough", "dropoff_service_zone",
]
ZONE_SELECT = f"""
  SELECT trip_date, PULocationID, DOLocationID, is_airport_trip,
    count(*) AS trip_count,
    {tot("total_amount")} AS total_revenue,
    {avg2("trip_miles")} AS avg_zone_distance,
    {avg2("trip_duration_minutes")} AS avg_zone_duration,
    {avg2("total_amount")} AS avg_fare_per_trip,
    {tot("driver_pay")} AS total_driver_pay,
    {", ".join(f"max({c}) AS {c}" for c in ZONE_NAMES)},
    {parts("year", "month", "day")}
  FROM enriched
  GROUP BY trip_date, PULocationID, DOLocationID, is_airport_trip"""

SERVICE_SELECT = f"""
  SELECT trip_date, day_of_week, is_weekend, shared_request_flag, wav_request_flag,
    count(*) AS trip_count,
    {tot("total_amount")} AS total_revenue,
    count(*) FILTER (WHERE shared_match_flag) AS shared_matched_count,
    count(*) FILTER (WHERE wav_match_flag) AS wav_matched_count,
    {parts("year", "month")}
  FROM enriched
  GROUP BY trip_date, day_of_week, is_weekend, shared_request_flag, wav_request_flag"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (RAW_CTE, CURATED_CTE, VALID_CTE, ZONES_CTE, ENRICHED_CTE)


def sql_daily_borough() -> str:
    return with_ctes(BOROUGH_SELECT, *BASE)


def sql_daily_zone() -> str:
    return with_ctes(ZONE_SELECT, *BASE)


def sql_daily_service() -> str:
    return with_ctes(SERVICE_SELECT, *BASE)


CURATED_OUT = [
    "hvfhs_license_num", "dispatching_base_num", "originating_base_num", *TS,
    "PULocationID", "DOLocationID", "trip_miles", "trip_time_seconds", *MONEY8, *FLAGS,
    "cbd_congestion_fee", "trip_date", "pickup_hour", "day_of_week", "is_weekend",
    "trip_duration_minutes", "total_fare", "total_amount", "avg_speed_mph", "is_airport_trip",
    "year", "month", "day",
]
RAW_OUT = [
    "hvfhs_license_num", "dispatching_base_num", "originating_base_num", *TS,
    "PULocationID", "DOLocationID", "trip_miles", "trip_time", *MONEY8, *FLAGS,
]
PASSES = f"coalesce({ALL_RULES}, false)"


def sql_validation_report() -> str:
    failed = ",\n    ".join(
        f"count(*) FILTER (WHERE NOT coalesce({r}, false)) AS failed_{n}" for n, r in RULES.items()
    )
    body = f"""
  SELECT input_rows, valid_rows, input_rows - valid_rows AS rejected_rows,
    CAST(CAST(((input_rows - valid_rows) * 2000000 + input_rows) // (2 * input_rows) AS DECIMAL(18,0))
         * 0.0001 AS DECIMAL(9,4)) AS rejected_pct,
    {", ".join(f"failed_{n}" for n in RULES)}
  FROM (SELECT count(*) AS input_rows, count(*) FILTER (WHERE {PASSES}) AS valid_rows,
    {failed}
    FROM curated) c"""
    return with_ctes(body, RAW_CTE, CURATED_CTE)


def sql_unmatched_zones() -> str:
    parts_ = []
    for role, c in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        parts_.append(f"""
  SELECT '{role}' AS role, {c} AS LocationID, count(*) AS trip_count
  FROM valid v WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.LocationID = v.{c})
  GROUP BY {c}""")
    return with_ctes("\n  UNION ALL".join(parts_), RAW_CTE, CURATED_CTE, VALID_CTE, ZONES_CTE)


def sql_preview() -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in CURATED_OUT)
    return with_ctes(f"SELECT {', '.join(CURATED_OUT)} FROM valid ORDER BY {order} LIMIT 5",
                     RAW_CTE, CURATED_CTE, VALID_CTE)


def sql_profile() -> str:
    parts_ = [
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM curated"
        for c in CURATED_OUT
    ]
    return with_ctes("\nUNION ALL\n".join(parts_), RAW_CTE, CURATED_CTE)


def pct(rows: str, base: str) -> str:
    return (f"CAST(CAST(({rows} * 2000000 + {base}) // (2 * {base}) AS DECIMAL(18,0)) * 0.0001 "
            f"AS DECIMAL(9,4))")


def sql_job_summary() -> str:
    body = f"""
  , counts AS (
    SELECT 'curated_trips' AS "table", (SELECT count(*) FROM valid) AS rows
    UNION ALL SELECT 'daily_borough', (SELECT count(*) FROM ({BOROUGH_SELECT}))
    UNION ALL SELECT 'daily_zone', (SELECT count(*) FROM ({ZONE_SELECT}))
    UNION ALL SELECT 'daily_service', (SELECT count(*) FROM ({SERVICE_SELECT}))
  )
  SELECT "table", rows, {pct("rows", "(SELECT count(*) FROM valid)")} AS pct_of_input FROM counts"""
    return with_ctes(body, *BASE)


def select_from(cte: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(cols)} FROM {cte}"


ORACLE: dict[str, str] = {
    "daily_borough": sql_daily_borough(),
    "daily_zone": sql_daily_zone(),
    "daily_service": sql_daily_service(),
    "curate_trips": with_ctes(select_from("curated", CURATED_OUT), RAW_CTE, CURATED_CTE),
    "null_default_money": with_ctes(
        select_from("curated", ["trip_miles", "trip_time_seconds", *MONEY8]), RAW_CTE, CURATED_CTE),
    "flag_to_boolean": with_ctes(
        "SELECT " + ", ".join([f"{c} AS {c}_raw" for c in FLAGS]
                              + [f"coalesce({c} = 'Y', false) AS {c}" for c in FLAGS])
        + " FROM raw_trips", RAW_CTE),
    "calendar_fields": with_ctes(select_from("curated", [
        "pickup_datetime", "trip_date", "pickup_hour", "day_of_week", "is_weekend",
        "year", "month", "day"]), RAW_CTE, CURATED_CTE),
    "trip_metrics": with_ctes(
        "SELECT trip_time, trip_miles, " + ", ".join(f"{e} AS {n}" for n, e in METRICS.items())
        + " FROM raw_trips", RAW_CTE),
    "validate_trips": with_ctes(select_from("valid", CURATED_OUT), RAW_CTE, CURATED_CTE, VALID_CTE),
    "rejected_trips": with_ctes(
        select_from("curated", CURATED_OUT) + f" WHERE NOT {PASSES}", RAW_CTE, CURATED_CTE),
    "validation_report": sql_validation_report(),
    "enrich_zones": with_ctes("SELECT * FROM enriched", *BASE),
    "unmatched_zones": sql_unmatched_zones(),
    "license_distribution": with_ctes(
        'SELECT hvfhs_license_num, count(*) AS "count" FROM raw_trips GROUP BY hvfhs_license_num',
        RAW_CTE),
    "preview_trips": sql_preview(),
    "profile_trips": sql_profile(),
    "job_summary": sql_job_summary(),
}

RAW_WITH_MONTH = [*RAW_OUT, "year", "month"]
LATEST = "(SELECT max(year * 12 + month) FROM raw_trips)"
VALID_ROWS = with_ctes(select_from("valid", CURATED_OUT), RAW_CTE, CURATED_CTE, VALID_CTE)

ORACLE.update({
    "scan_raw_trips": with_ctes(select_from("raw_trips", RAW_WITH_MONTH), RAW_CTE),
    "scan_target_month": with_ctes(
        select_from("valid", CURATED_OUT) + " WHERE year = 1998 AND month = 2",
        RAW_CTE, CURATED_CTE, VALID_CTE),
    "scan_zone_lookup": with_ctes("SELECT * FROM zones", ZONES_CTE),
    "scan_catalog_table": with_ctes(select_from("raw_trips", RAW_WITH_MONTH), RAW_CTE),
    "roundtrip_curated_overwrite": VALID_ROWS,
    "roundtrip_borough_overwrite": sql_daily_borough(),
    "roundtrip_append": VALID_ROWS,
    "target_month_refresh": sql_daily_borough(),
    "curated_trips": VALID_ROWS,
    "incremental_curate": VALID_ROWS,
    "incremental_aggregate": sql_daily_borough(),
    "latest_month": with_ctes(
        "SELECT year, month FROM raw_trips ORDER BY year DESC, month DESC LIMIT 1", RAW_CTE),
    "slice_current": with_ctes(
        select_from("raw_trips", RAW_WITH_MONTH) + f" WHERE year * 12 + month = {LATEST}", RAW_CTE),
    "slice_historical": with_ctes(
        select_from("raw_trips", RAW_WITH_MONTH)
        + f" WHERE year >= 1997 AND year * 12 + month < {LATEST}", RAW_CTE),
    "new_partitions_only": with_ctes(
        "SELECT year, month, count(*) AS rows FROM raw_trips WHERE year > 1998 GROUP BY year, month",
        RAW_CTE),
    "landing_manifest": with_ctes(
        "SELECT year, month, count(*) AS row_count, CAST(1 AS BIGINT) AS file_count, "
        "min(pickup_datetime) AS first_event, max(pickup_datetime) AS last_event "
        "FROM raw_trips GROUP BY year, month", RAW_CTE),
})

ORACLE.update({
    "shared_scan_borough": sql_daily_borough(),
    "shared_scan_zone": sql_daily_zone(),
    "shared_scan_service": sql_daily_service(),
})

ORACLE.update({
    **{f"{job}_zone": sql_daily_zone() for job in ("target_month_refresh", "incremental_aggregate", "chained_run")},
    **{f"{job}_service": sql_daily_service() for job in ("target_month_refresh", "incremental_aggregate", "chained_run")},
    "chained_run_borough": sql_daily_borough(),
    "pipeline_summary": sql_job_summary(),
    "curated_other_types": VALID_ROWS,
})

ORACLE.update({
    "relanded_curate": VALID_ROWS,
    "refresh_then_increment_borough": sql_daily_borough(),
    "refresh_then_increment_zone": sql_daily_zone(),
    "refresh_then_increment_service": sql_daily_service(),
})

COUNT_VALID = "(SELECT count(*) FROM valid)"
ORACLE.update({
    "files_to_land": ORACLE["new_partitions_only"].replace("count(*) AS rows", "CAST(count(*) AS BIGINT) AS rows"),
    "profile_by_day": with_ctes("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM valid" for c in CURATED_OUT), RAW_CTE, CURATED_CTE, VALID_CTE),
    "curated_mixed_types": VALID_ROWS,
    "partition_discovery": with_ctes("SELECT DISTINCT year, month FROM raw_trips", RAW_CTE),
    "written_compression": with_ctes("SELECT 'snappy' AS codec, count(*) AS rows FROM valid", RAW_CTE, CURATED_CTE, VALID_CTE),
    "processing_stamp": with_ctes("SELECT count(*) AS rows, count(*) AS stamped, CAST(1 AS BIGINT) AS stamps FROM valid", RAW_CTE, CURATED_CTE, VALID_CTE),
    "empty_input": with_ctes(
        "SELECT job, outcome, " + COUNT_VALID + " AS curated_rows FROM (VALUES ('curate, full', 'EmptyInputError'), "
        "('marts of a month without trips', 'EmptyInputError'), ('curate, increment', '0 batches'), ('marts, increment', '0 batches')) AS t(job, outcome)",
        RAW_CTE, CURATED_CTE, VALID_CTE),
})
