"""Compaction of an incremental curated table: many small batches of a day become few files.

Every micro-batch leaves files of its own under each day it holds.  A
planner looks at the listing alone: a day needs as many files as its bytes fill; a
day that has over ``slack`` times as many is rewritten, days being packed into
rounds of bounded bytes, first fit by falling size.  A round's rows are written as one
batch with a number of its own, in place of the files they come from, in one publication.

Rows keep the raw file they come from, so they can still be taken back.  The new
files carry the state of the files they stand for, so the marts take no day for a changed one.
Appended marts read files, not states: they refuse a compacted table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.plans.jobs import guard_layout
from tripmart.schemas import BATCH_COLUMN, CURATED_PARTITIONS
from tripmart.session import with_job_settings
from tripmart.sinks.publish import Publication
from tripmart.sources.states import STAND_IN_SCHEMA, STAND_INS, Day, day_files, days_of
from tripmart.streaming.incremental import CURATED_SOURCED, partitions_in

TARGET_BYTES = 128 << 20
#: Bytes rewritten in one publication.
ROUND_BYTES = 1 << 40
SLACK = 2.0


@dataclass(frozen=True)
class DayFiles:
    day: Day
    files: int
    bytes: int
    state: int
    folders: tuple[str, ...]

    def needed(self, target: int) -> int:
        return max(1, -(-self.bytes // target))


def plan(days: list[DayFiles], target: int = TARGET_BYTES, round_bytes: int = ROUND_BYTES, slack: float = SLACK) -> list[list[DayFiles]]:
    """Days worth rewriting, packed into rounds: first fit by falling size; a larger day is a round of its own."""
    rounds: list[tuple[int, list[DayFiles]]] = []
    for d in sorted((d for d in days if d.files > slack * d.needed(target)), key=lambda d: (-d.bytes, d.day)):
        for i, (size, members) in enumerate(rounds):
            if size + d.bytes <= round_bytes:
                rounds[i] = (size + d.bytes, [*members, d])
                break
        else:
            rounds.append((d.bytes, [d]))
    return [members for _, members in rounds]


def days_on_disk(spark: SparkSession, out: str) -> list[DayFiles]:
    """Files, bytes, state and folders of each day (a row a day, and a name a batch that holds it, reach the driver)."""
    rows = day_files(spark, out).groupBy(*CURATED_PARTITIONS).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.bit_xor("state").alias("state"), F.collect_set("folder").alias("folders"))
    return [DayFiles((r.year, r.month, r.day), r.files, r.bytes, r.state, tuple(sorted(r.folders))) for r in rows.collect()]


@with_job_settings
def compact_curated(spark: SparkSession, out: str, target: int = TARGET_BYTES, round_bytes: int = ROUND_BYTES, slack: float = SLACK) -> list[int]:
    """Rewrite the days with too many files; returns how many days each publication rewrote."""
    guard_layout(spark, out, incremental=True)
    return [_rewrite(spark, out, days) for days in plan(days_on_disk(spark, out), target, round_bytes, slack)]


def _rewrite(spark: SparkSession, out: str, days: list[DayFiles]) -> int:
    with Publication(spark, out) as pub:
        rows = spark.read.schema(CURATED_SOURCED).parquet(out).where(partitions_in(CURATED_PARTITIONS, [d.day for d in days]))
        pub.write(rows.withColumn(BATCH_COLUMN, F.lit(pub.correction_number()).cast("long")), "", [BATCH_COLUMN, *CURATED_PARTITIONS], mode="dynamic")
        pub.drop("", [f for d in days for f in d.folders])
        # of a day's new files one carries the state of all the old ones, the others nothing
        left = {d.day: d.state for d in days}
        stand_ins = []
        for name in sorted(pub.files("")):
            day = days_of([name.split("/", 1)[1].rpartition("/")[0]]).pop()
            stand_ins.append((name, left.pop(day, 0)))
        pub.write(spark.createDataFrame(stand_ins, STAND_IN_SCHEMA).coalesce(1), STAND_INS, mode="append")
        pub.commit()
    return len(days)
