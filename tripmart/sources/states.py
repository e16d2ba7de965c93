"""Which state of the curated table the marts were made from, day by day.

The state of a day is a digest of its files' names, sizes and times, in any
order: a listing tells whether a day was added, changed or removed since
its partials were made, without opening a file.  Files that stand for others with the
same rows (a compaction) carry the state of those.  The marts' root keeps the
states its partials come from, published together with them.  A day
whose state differs is stale and is made again before anything is rolled up.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import CURATED_PARTITIONS
from tripmart.sinks.fs import exists
from tripmart.sinks.publish import STAGED
from tripmart.sources.ledger import listed_files

STATES = "_day_states"
#: Files written in place of others: their path below the root and the state that each counts with.
STAND_INS = "_stand_ins"
STAND_IN_SCHEMA = "within string, state long"
SCHEMA = "year int, month int, day int, state long"
#: State of a day whose rows did not come from the curated table as it is; equal to no digest's presence in a listing.
UNKNOWN = None

Day = tuple[int, int, int]


def day_files(spark: SparkSession, curated_root: str) -> DataFrame:
    """year, month, day, folder, within (path below the root), size, state of every curated file: a listing."""
    path = F.col("path")
    within = F.regexp_extract(path, r"/((batch_id=-?\d+/)?year=\d+/month=\d+/day=\d+/[^/]+)$", 1)
    files = listed_files(spark, curated_root).withColumn("within", within).where((within != "") & ~path.contains(f"/{STAGED}/"))
    numbers = [F.regexp_extract("within", rf"(^|/){p}=(\d+)/", 2).cast("int").alias(p) for p in CURATED_PARTITIONS]
    own = F.xxhash64("within", "size", "modified")
    if exists(spark, f"{curated_root}/{STAND_INS}"):
        stand_ins = spark.read.schema(STAND_IN_SCHEMA).parquet(f"{curated_root}/{STAND_INS}").groupBy("within").agg(F.first("state").alias("other"))
        files, own = files.join(stand_ins, "within", "left"), F.coalesce("other", own)
    return files.select(*numbers, F.regexp_extract("within", r"^(.*)/[^/]+$", 1).alias("folder"), "within", "size", own.alias("state"))


def day_states(spark: SparkSession, curated_root: str) -> dict[Day, int]:
    """The current state of every day (a row a day reaches the driver: bounded by the calendar)."""
    if not exists(spark, curated_root):
        return {}
    days = day_files(spark, curated_root).groupBy(*CURATED_PARTITIONS).agg(F.bit_xor("state").alias("state"))
    return {(r.year, r.month, r.day): r.state for r in days.collect()}


def recorded_states(spark: SparkSession, marts_root: str) -> dict[Day, int | None]:
    path = f"{marts_root}/{STATES}"
    if not exists(spark, path):
        return {}
    return {(r.year, r.month, r.day): r.state for r in spark.read.schema(SCHEMA).parquet(path).collect()}


def states_frame(spark: SparkSession, states: dict[Day, int | None]) -> DataFrame:
    return spark.createDataFrame([(*d, s) for d, s in sorted(states.items())], SCHEMA).coalesce(1)


def days_of(partitions: Iterable[str]) -> set[Day]:
    """Days of partition folders like ``year=2024/month=1/day=9``."""
    return {tuple(int(x.split("=")[1]) for x in p.split("/")) for p in partitions if p.count("=") == 3}


def folder(values: tuple, names: list[str] = CURATED_PARTITIONS) -> str:
    return "/".join(f"{n}={v}" for n, v in zip(names, values))
