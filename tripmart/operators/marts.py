"""The three daily marts and the licence distribution.

Every mart is built from *partials*: per-key trip counts, exact decimal
sums and non-null counts, which can be merged again at any coarser key.

* Spark runs each ``groupBy`` as a map-side partial aggregation, a shuffle
  on the keys and a final merge, so a hot day or zone pair is pre-combined
  in every task and never lands whole in one task.
* Zone names depend only on the ids (the dimension is checked unique),
  so the zone mart aggregates by id first and joins the six names to the
  much smaller result (aggregate before join): no name string is shuffled.
  The borough mart joins first (a map-side broadcast probe) so that its
  shuffle is keyed by borough pair, the coarser key.
* A job that writes all three marts computes the partials once at the
  finest common grain (``CUBE_KEYS``), writes them to the shared folder and
  rolls all three marts up from there: one scan of the curated table.

Rounding is that of ``sum``/``avg`` on decimal(10,2): totals are exact and
narrowed to decimal(12,2); an average is the exact quotient rounded
HALF_UP to 6 places (Spark's avg result, decimal(14,6)) and then HALF_UP to
decimal(10,2).  Narrowing is ``try_cast``: NULL on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.enrich import enrich_zones
from tripmart.schemas import MONEY, TOTAL

BOROUGH_KEYS = ["trip_date", "day_of_week", "is_weekend", "pickup_borough", "dropoff_borough"]
BOROUGH_ID_KEYS = ["trip_date", "day_of_week", "is_weekend", "PULocationID", "DOLocationID"]
ZONE_KEYS = ["trip_date", "PULocationID", "DOLocationID", "is_airport_trip"]
SERVICE_KEYS = ["trip_date", "day_of_week", "is_weekend", "shared_request_flag", "wav_request_flag"]
# Finest grain every mart can be rolled up from.
CUBE_KEYS = [
    "trip_date", "day_of_week", "is_weekend", "PULocationID", "DOLocationID",
    "is_airport_trip", "shared_request_flag", "wav_request_flag",
]
ZONE_NAME_COLUMNS = [
    "pickup_zone", "pickup_borough", "pickup_service_zone",
    "dropoff_zone", "dropoff_borough", "dropoff_service_zone",
]
# Partition layout of each mart on disk.
MART_PARTITIONS = {
    "daily_borough": ["year", "month"],
    "daily_zone": ["year", "month", "day"],
    "daily_service": ["year", "month"],
}
# Measures: name of the partial column -> (how trips make it, how partials merge).
SUMMED = {"amount": "total_amount", "miles": "trip_miles",
          "minutes": "trip_duration_minutes", "pay": "driver_pay"}
COUNTED_FLAGS = {"shared_match": "shared_match_flag", "wav_match": "wav_match_flag"}


def partials(trips: DataFrame, keys: list[str]) -> DataFrame:
    """Per-key partials: trips, and for each measure its sum and non-null count.

    Unused measures are pruned by Catalyst from the aggregation.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, col in SUMMED.items():
        aggs += [F.sum(col).alias(f"s_{name}"), F.count(col).alias(f"n_{name}")]
    aggs += [F.count_if(col).alias(f"n_{name}") for name, col in COUNTED_FLAGS.items()]
    return trips.groupBy(*keys).agg(*aggs)


PARTIAL_COLUMNS = ["n"] + [f"{p}_{m}" for m in SUMMED for p in ("s", "n")] + [f"n_{m}" for m in COUNTED_FLAGS]


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Partials merged to a coarser key: sums of sums, sums of counts."""
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in PARTIAL_COLUMNS])


def total(name: str) -> Column:
    return F.col(f"s_{name}").try_cast(TOTAL)


def mean(name: str) -> Column:
    """avg from parts, rounded as Spark's avg(decimal(10,2)) then cast to (10,2).

    decimal(34,2) / bigint has result scale exactly 6 (HALF_UP), the scale
    of avg's decimal(14,6) result.
    """
    q = F.try_divide(F.col(f"s_{name}").cast("decimal(34,2)"), F.col(f"n_{name}"))
    return q.try_cast("decimal(14,6)").try_cast(MONEY)


def with_date_parts(df: DataFrame, parts: list[str]) -> DataFrame:
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({p: fns[p]("trip_date") for p in parts})


def borough_from(parts: DataFrame, zones: DataFrame | None = None, checked_size: int | None = None,
                 grouped: bool = False) -> DataFrame:
    """daily_borough from partials.

    ``grouped``: already one row per ``BOROUGH_KEYS``.  Otherwise the parts
    are keyed by zone ids (at least ``BOROUGH_ID_KEYS``): joined to the
    borough names and merged once, by the coarser key.
    """
    if grouped:
        agg = parts
    else:
        keep = BOROUGH_ID_KEYS + PARTIAL_COLUMNS
        agg = merge(enrich_zones(parts, zones, checked_size, keep=keep), BOROUGH_KEYS)
    out = agg.select(
        *BOROUGH_KEYS,
        F.col("n").alias("trip_count"),
        total("amount").alias("total_revenue"),
        total("miles").alias("total_distance"),
        F.col("s_minutes").try_cast("bigint").alias("total_duration"),
        mean("miles").alias("avg_borough_distance"),
        mean("minutes").alias("avg_borough_duration"),
    )
    return with_date_parts(out, MART_PARTITIONS["daily_borough"])


def zone_from(parts: DataFrame, zones: DataFrame, checked_size: int | None = None,
              grouped: bool = False) -> DataFrame:
    """daily_zone from partials (``grouped``: already one row per ``ZONE_KEYS``)."""
    agg = (parts if grouped else merge(parts, ZONE_KEYS)).select(
        *ZONE_KEYS,
        F.col("n").alias("trip_count"),
        total("amount").alias("total_revenue"),
        mean("miles").alias("avg_zone_distance"),
        mean("minutes").alias("avg_zone_duration"),
        mean("amount").alias("avg_fare_per_trip"),
        total("pay").alias("total_driver_pay"),
    )
    named = enrich_zones(agg, zones, checked_size, keep=agg.columns)
    out = named.select(*agg.columns, *ZONE_NAME_COLUMNS)
    return with_date_parts(out, MART_PARTITIONS["daily_zone"])


def service_from(parts: DataFrame, grouped: bool = False) -> DataFrame:
    """daily_service from partials.  It uses no zone column, so no join."""
    agg = (parts if grouped else merge(parts, SERVICE_KEYS)).select(
        *SERVICE_KEYS,
        F.col("n").alias("trip_count"),
        total("amount").alias("total_revenue"),
        F.col("n_shared_match").alias("shared_matched_count"),
        F.col("n_wav_match").alias("wav_matched_count"),
    )
    return with_date_parts(agg, MART_PARTITIONS["daily_service"])


def daily_borough(trips: DataFrame, zones: DataFrame, checked_size: int | None = None) -> DataFrame:
    """Per day and borough pair; boroughs of unknown ids are NULL (own group).

    Here the join comes first: the broadcast probe is map-side and cheap,
    and the partial aggregation that follows is keyed by borough pair (a
    few dozen per day) instead of zone pair, so far less is shuffled.
    """
    enriched = enrich_zones(trips, zones, checked_size)
    return borough_from(partials(enriched, BOROUGH_KEYS), grouped=True)


def daily_zone(trips: DataFrame, zones: DataFrame, checked_size: int | None = None) -> DataFrame:
    """Per day and zone pair, with the six zone names."""
    return zone_from(partials(trips, ZONE_KEYS), zones, checked_size, grouped=True)


def daily_service(trips: DataFrame, zones: DataFrame | None = None,
                  checked_size: int | None = None) -> DataFrame:
    """Per day and service flags."""
    return service_from(partials(trips, SERVICE_KEYS), grouped=True)


MARTS = {
    "daily_borough": daily_borough,
    "daily_zone": daily_zone,
    "daily_service": daily_service,
}


def marts_from_cube(cube: DataFrame, zones: DataFrame, checked_size: int | None = None) -> dict[str, DataFrame]:
    """All three marts rolled up from partials at ``CUBE_KEYS``."""
    return {
        "daily_borough": borough_from(cube, zones, checked_size),
        "daily_zone": zone_from(cube, zones, checked_size),
        "daily_service": service_from(cube),
    }


def license_distribution(raw: DataFrame) -> DataFrame:
    """Trips per licence, most frequent first (licence breaks ties)."""
    return (
        raw.groupBy("hvfhs_license_num")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_last("hvfhs_license_num"))
    )
