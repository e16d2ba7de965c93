"""Trip -> zone enrichment: the zone dimension joined in two roles.

The dimension is checked once (one tiny aggregation) for duplicate keys
and for its size in bytes.  Only one of at most ``BROADCAST_MAX_BYTES`` is
broadcast; a larger one is joined by shuffle, with the few ids that a large share of the trips
has split off (``operators.skew``).
The same DataFrame serves both roles, so the broadcast is built once and
reused (``ReusedExchange``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripmart.operators.skew import frequent_keys, spread_left_join

# Largest zone table, as its measured size, broadcast to every executor.
BROADCAST_MAX_BYTES = 16 << 20
# What a row takes besides its text.
ROW_BYTES = 64

ENRICHED_TRIP_COLUMNS = [
    "trip_date",
    "day_of_week",
    "is_weekend",
    "PULocationID",
    "DOLocationID",
    "shared_request_flag",
    "shared_match_flag",
    "wav_request_flag",
    "wav_match_flag",
    "is_airport_trip",
    "total_amount",
    "trip_miles",
    "trip_duration_minutes",
    "driver_pay",
]
ZONE_ROLES = {"pu": "pickup", "do": "dropoff"}
ZONE_FIELDS = {"Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}


class DimensionError(ValueError):
    pass


def check_zones(zones: DataFrame) -> int:
    """Raise on an empty zone table or duplicate ``LocationID``; return its bytes.

    Rows without an id can't match any trip, so they duplicate nothing.
    """
    text = sum((F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in zones.schema.fields
                if isinstance(f.dataType, StringType)), F.lit(ROW_BYTES))
    rows, ids, keys, size = zones.agg(
        F.count(F.lit(1)), F.count("LocationID"), F.count_distinct("LocationID"), F.sum(text.cast("long"))
    ).first()
    if rows == 0:
        raise DimensionError("zone lookup table is empty")
    if keys != ids:
        raise DimensionError(
            f"zone lookup has {ids} rows with an id but {keys} distinct LocationID values; "
            "a duplicate key would multiply trips"
        )
    return size


def sized_for_join(zones: DataFrame, size: int | None = None) -> DataFrame:
    """The checked dimension, broadcast only when its size is proven small."""
    size = check_zones(zones) if size is None else size
    return F.broadcast(zones) if size <= BROADCAST_MAX_BYTES else zones


def enrich_zones(
    trips: DataFrame,
    zones: DataFrame,
    checked_size: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Trips with pickup and dropoff borough/zone/service zone (left joins).

    Unknown ids keep the trip with NULL names.  ``keep`` lists the trip
    columns carried along (default: those the marts use).
    """
    size = check_zones(zones) if checked_size is None else checked_size
    if size > BROADCAST_MAX_BYTES:
        return _enrich_by_shuffle(trips, zones, keep)
    dim = sized_for_join(zones, size)
    pu, do = dim.alias("pu"), dim.alias("do")
    t = trips.alias("t")
    joined = t.join(pu, F.col("t.PULocationID") == F.col("pu.LocationID"), "left").join(
        do, F.col("t.DOLocationID") == F.col("do.LocationID"), "left"
    )
    return joined.select(
        *[F.col(f"t.{c}") for c in (keep or ENRICHED_TRIP_COLUMNS)],
        *[F.col(f"{alias}.{src}").alias(f"{role}_{dst}")
          for alias, role in ZONE_ROLES.items() for src, dst in ZONE_FIELDS.items()],
    )


def _enrich_by_shuffle(trips: DataFrame, zones: DataFrame, keep: list[str] | None) -> DataFrame:
    """The same rows without broadcasting the dimension."""
    ids = {"pu": "PULocationID", "do": "DOLocationID"}
    frequent = frequent_keys(trips, list(ids.values()))
    dim = zones.select("LocationID", *ZONE_FIELDS)
    joined = trips
    for alias, column in ids.items():
        joined = spread_left_join(joined, dim, column, "LocationID", frequent[column], f"__{alias}")
    return joined.select(
        *(keep or ENRICHED_TRIP_COLUMNS),
        *[F.col(f"__{alias}.{src}").alias(f"{role}_{dst}") for alias, role in ZONE_ROLES.items() for src, dst in ZONE_FIELDS.items()],
    )


def unmatched_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Location ids used by trips that have no zone row, per role, with trip counts.

    One scan of the trips yields both roles as (role, id) pairs; they are
    counted per id (map-side partial aggregation, one shuffle) and only the
    per-id counts meet the zone keys in a broadcast anti join.
    """
    dim = sized_for_join(zones).select("LocationID")
    roles = F.array(
        F.struct(F.lit("pickup").alias("role"), F.col("PULocationID").alias("LocationID")),
        F.struct(F.lit("dropoff").alias("role"), F.col("DOLocationID").alias("LocationID")),
    )
    per_id = (
        trips.select(F.inline(roles))
        .where(F.col("LocationID").isNotNull())
        .groupBy("role", "LocationID")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )
    return per_id.join(dim, "LocationID", "left_anti").select("role", "LocationID", "trip_count")
