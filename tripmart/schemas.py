"""Table schemas and the fixed values of the curated layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(10, 2)
TOTAL = DecimalType(12, 2)

# --- fixed values (must equal the source system's rules) -------------------
# Licence numbers accepted by validation.
VALID_LICENSES = ["HV0002", "HV0003", "HV0004", "HV0005"]
# Closed ranges enforced on the curated (rounded) values.
TRIP_MILES_RANGE = (0, 500)
BASE_FARE_RANGE = (0, 10000)
# Flag value that means "yes"; anything else (including null) is "no".
FLAG_YES = "Y"
# ---------------------------------------------------------------------------

# Charges summed (in this order) into total_fare; total_amount adds tips.
FARE_CHARGES = [
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
]
FLAG_COLUMNS = [
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
]
TIMESTAMP_COLUMNS = [
    "request_datetime",
    "on_scene_datetime",
    "pickup_datetime",
    "dropoff_datetime",
]

RAW = StructType(
    [
        StructField("hvfhs_license_num", StringType()),
        StructField("dispatching_base_num", StringType()),
        StructField("originating_base_num", StringType()),
        StructField("request_datetime", TimestampType()),
        StructField("on_scene_datetime", TimestampType()),
        StructField("pickup_datetime", TimestampType()),
        StructField("dropoff_datetime", TimestampType()),
        StructField("PULocationID", IntegerType()),
        StructField("DOLocationID", IntegerType()),
        StructField("trip_miles", DoubleType()),
        StructField("trip_time", LongType()),
        StructField("base_passenger_fare", DoubleType()),
        StructField("tolls", DoubleType()),
        StructField("bcf", DoubleType()),
        StructField("sales_tax", DoubleType()),
        StructField("congestion_surcharge", DoubleType()),
        StructField("airport_fee", DoubleType()),
        StructField("tips", DoubleType()),
        StructField("driver_pay", DoubleType()),
        StructField("shared_request_flag", StringType()),
        StructField("shared_match_flag", StringType()),
        StructField("access_a_ride_flag", StringType()),
        StructField("wav_request_flag", StringType()),
        StructField("wav_match_flag", StringType()),
    ]
)
# Landing layout: one directory level per file month.
RAW_PARTITIONS = StructType(
    [StructField("year", IntegerType()), StructField("month", IntegerType())]
)
RAW_LANDED = StructType(RAW.fields + RAW_PARTITIONS.fields)
# Newer source files carry this fee too; files without it read as null.
CBD_FEE = StructField("cbd_congestion_fee", DoubleType())

ZONE = StructType(
    [
        StructField("LocationID", IntegerType()),
        StructField("Borough", StringType()),
        StructField("Zone", StringType()),
        StructField("service_zone", StringType()),
    ]
)

CURATED = StructType(
    [
        StructField("hvfhs_license_num", StringType()),
        StructField("dispatching_base_num", StringType()),
        StructField("originating_base_num", StringType()),
        *[StructField(c, TimestampType()) for c in TIMESTAMP_COLUMNS],
        StructField("PULocationID", IntegerType()),
        StructField("DOLocationID", IntegerType()),
        StructField("trip_miles", MONEY),
        StructField("trip_time_seconds", IntegerType()),
        *[StructField(c, MONEY) for c in [*FARE_CHARGES, "tips", "driver_pay"]],
        *[StructField(c, BooleanType(), False) for c in FLAG_COLUMNS],
        StructField("cbd_congestion_fee", MONEY),
        StructField("trip_date", DateType()),
        StructField("pickup_hour", IntegerType()),
        StructField("day_of_week", StringType(), False),
        StructField("is_weekend", BooleanType(), False),
        StructField("trip_duration_minutes", MONEY),
        StructField("total_fare", MONEY),
        StructField("total_amount", MONEY),
        StructField("avg_speed_mph", MONEY),
        StructField("is_airport_trip", BooleanType(), False),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("day", IntegerType()),
        StructField("processing_timestamp", TimestampType(), False),
    ]
)
CURATED_PARTITIONS = ["year", "month", "day"]
# Incremental runs write each micro-batch under a leading ``batch_id=N/``
# directory level; a reader with this schema accepts both layouts.
BATCH_COLUMN = "batch_id"
CURATED_ANY_LAYOUT = StructType(
    CURATED.fields[:-4] + [StructField(BATCH_COLUMN, LongType())] + CURATED.fields[-4:]
)
CURATED_COLUMNS = [f.name for f in CURATED.fields]
