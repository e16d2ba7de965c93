"""Raw trips -> curated trips: one projection, no shuffle.

The projection is a single ``select`` of built-in expressions; Catalyst
fuses it with the scan (column pruning, pushed not-null/IN filters) into
one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.columns import (
    amount,
    charges_sum,
    flag,
    is_weekend,
    minutes,
    money,
    positive_fee,
    speed_mph,
    to_money,
    weekday_name,
)
from tripmart.schemas import (
    CURATED_COLUMNS,
    FARE_CHARGES,
    FLAG_COLUMNS,
    MONEY,
    TIMESTAMP_COLUMNS,
)


def money_columns() -> list[Column]:
    """The nine null-defaulted money/distance columns (after the id columns)."""
    cols = [money("trip_miles").alias("trip_miles")]
    cols.append(F.col("trip_time").try_cast("int").alias("trip_time_seconds"))
    cols += [money(c).alias(c) for c in [*FARE_CHARGES, "tips", "driver_pay"]]
    return cols


def flag_columns() -> list[Column]:
    return [flag(c).alias(c) for c in FLAG_COLUMNS]


def calendar_columns(ts: str = "pickup_datetime") -> dict[str, Column]:
    """Calendar fields of the (session-zone, UTC) pickup wall clock."""
    t = F.col(ts).try_cast("timestamp")
    return {
        "trip_date": t.cast("date"),
        "pickup_hour": F.hour(t),
        "day_of_week": weekday_name(t),
        "is_weekend": is_weekend(t),
    }


def partition_columns(ts: str = "pickup_datetime") -> dict[str, Column]:
    t = F.col(ts).try_cast("timestamp")
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t)}


def metric_columns(use_cbd_fee: bool = False) -> dict[str, Column]:
    cbd = amount("cbd_congestion_fee") if use_cbd_fee else None
    return {
        "trip_duration_minutes": minutes("trip_time"),
        "total_fare": to_money(charges_sum(cbd)),
        "total_amount": to_money(charges_sum(cbd, with_tips=True)),
        "avg_speed_mph": speed_mph("trip_miles", "trip_time"),
        "is_airport_trip": positive_fee("airport_fee"),
    }


def curate_trips(raw: DataFrame, use_cbd_fee: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed and enriched trips; all other raw columns but those of ``keep`` are dropped.

    ``use_cbd_fee`` reads the source's congestion-zone fee instead of the
    constant 0.00 (default, as the source system writes it).
    """
    cbd = money("cbd_congestion_fee") if use_cbd_fee else F.lit(0).cast(MONEY)
    cal = calendar_columns()
    parts = partition_columns()
    metrics = metric_columns(use_cbd_fee)
    out = raw.select(
        F.col("hvfhs_license_num").cast("string").alias("hvfhs_license_num"),
        F.col("dispatching_base_num").cast("string").alias("dispatching_base_num"),
        F.col("originating_base_num").cast("string").alias("originating_base_num"),
        *[F.col(c).try_cast("timestamp").alias(c) for c in TIMESTAMP_COLUMNS],
        F.col("PULocationID").try_cast("int").alias("PULocationID"),
        F.col("DOLocationID").try_cast("int").alias("DOLocationID"),
        *money_columns(),
        *flag_columns(),
        cbd.alias("cbd_congestion_fee"),
        *[e.alias(n) for n, e in cal.items()],
        *[e.alias(n) for n, e in metrics.items()],
        *[e.alias(n) for n, e in parts.items()],
        F.current_timestamp().alias("processing_timestamp"),
        *keep,
    )
    return out.select(*CURATED_COLUMNS, *keep)
