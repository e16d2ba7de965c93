"""Named data-quality rules over curated trips.

A rule is a boolean ``Column``; NULL counts as a failure (three-valued AND
in a filter).  The report computes every count in a single aggregation
pass, so validating never costs more than one extra scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import BASE_FARE_RANGE, TRIP_MILES_RANGE, VALID_LICENSES


def rules() -> dict[str, Column]:
    """Rule name -> predicate, in the order they are reported."""
    miles, fare = F.col("trip_miles"), F.col("base_passenger_fare")
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return {
        "pickup_not_null": pickup.isNotNull(),
        "dropoff_not_null": dropoff.isNotNull(),
        "pu_location_not_null": F.col("PULocationID").isNotNull(),
        "do_location_not_null": F.col("DOLocationID").isNotNull(),
        "miles_min": miles >= TRIP_MILES_RANGE[0],
        "miles_max": miles <= TRIP_MILES_RANGE[1],
        "fare_min": fare >= BASE_FARE_RANGE[0],
        "fare_max": fare <= BASE_FARE_RANGE[1],
        "dropoff_after_pickup": dropoff > pickup,
        "pickup_not_before_request": pickup >= F.col("request_datetime"),
        "license_known": F.col("hvfhs_license_num").isin(VALID_LICENSES),
    }


def all_rules() -> Column:
    return reduce(and_, rules().values())


def passes() -> Column:
    """True when every rule holds; never NULL."""
    return F.coalesce(all_rules(), F.lit(False))


def validate_trips(curated: DataFrame) -> DataFrame:
    """Rows that pass every rule (NULL rejects)."""
    return curated.where(all_rules())


def rejected_trips(curated: DataFrame) -> DataFrame:
    """The exact complement of ``validate_trips``."""
    return curated.where(~passes())


def validation_report(curated: DataFrame) -> DataFrame:
    """One row: input, valid, rejected, rejected %, and failures per rule."""
    per_rule = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"failed_{name}")
        for name, rule in rules().items()
    ]
    counts = curated.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(passes()).alias("valid_rows"),
        *per_rule,
    )
    rejected = F.col("input_rows") - F.col("valid_rows")
    pct = F.try_divide(rejected.cast("decimal(20,0)") * F.lit(100), F.col("input_rows"))
    return counts.select(
        "input_rows",
        "valid_rows",
        rejected.alias("rejected_rows"),
        pct.try_cast("decimal(9,4)").alias("rejected_pct"),
        *[f"failed_{name}" for name in rules()],
    )
