"""A table's profile kept by day: an increment reads only the days that changed.

Each day of the curated table leaves one row of mergeable numbers (rows, non-nulls,
extremes of every column).  As for the marts, the states that the rows were made from are
published with them, so new, late, taken back and removed days are found from a listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators.reports import merged_profile, profile_parts
from tripmart.schemas import CURATED_PARTITIONS
from tripmart.session import with_job_settings
from tripmart.sinks.fs import exists
from tripmart.sinks.publish import Publication, recover
from tripmart.sources.states import STATES, day_states, recorded_states, states_frame
from tripmart.sources.tables import scan_curated
from tripmart.streaming.incremental import partitions_in

PARTS = "profile_parts"
#: Every run stamps its rows anew: no property of the data.
LEFT_OUT = ["processing_timestamp"]


@with_job_settings
def refresh_profile(spark: SparkSession, curated_root: str, out_root: str) -> list[tuple]:
    """Bring the parts up to date; returns the days that were read or dropped."""
    recover(spark, out_root)
    current, known = day_states(spark, curated_root), recorded_states(spark, out_root)
    stale = sorted(d for d in current.keys() | known.keys() if d not in current or known.get(d) != current[d])
    if not stale:
        return []
    with Publication(spark, out_root) as pub:
        days = scan_curated(spark, curated_root).where(partitions_in(CURATED_PARTITIONS, stale)).drop(*LEFT_OUT)
        parts = profile_parts(days, CURATED_PARTITIONS)
        if exists(spark, f"{out_root}/{PARTS}"):
            parts = parts.unionByName(spark.read.schema(parts.schema).parquet(f"{out_root}/{PARTS}").where(~partitions_in(CURATED_PARTITIONS, stale)))
        pub.write(parts.coalesce(1), PARTS)  # a row a day
        pub.write(states_frame(spark, current), STATES)
        pub.commit()
    return stale


def read_profile(spark: SparkSession, out_root: str) -> DataFrame:
    """The profile of the whole table from its days' parts."""
    columns = [c for c in scan_columns() if c not in LEFT_OUT]
    return merged_profile(spark.read.parquet(f"{out_root}/{PARTS}"), columns)


def scan_columns() -> list[str]:
    from tripmart.schemas import BATCH_COLUMN, CURATED_ANY_LAYOUT

    return [c for c in CURATED_ANY_LAYOUT.fieldNames() if c != BATCH_COLUMN]
