"""Incremental runs: new and changed raw files -> curated -> marts.

* Curated: a file stream with a checkpoint takes the files not seen before
  (``availableNow``: everything new, then it stops).  A ledger beside
  the table knows which file, in which state, is in which batch.  Files that are
  gone or were replaced, as when a month is landed again, are taken back:
  only the days that hold their rows are written again.  Each micro-batch,
  its ledger entries included, is published at once and once; a
  batch repeated after a failure is passed over.
* Marts (``on_touch="recompute"``, default): every day of the curated
  table has a state, read from a listing, and the marts' root keeps the states that its
  partials were made from.  Days that differ, be they new, late,
  taken back or changed under a month's refresh, get new partials; each mart
  partition that holds one is rolled up again from partials that are all up to date.
  Partials, marts and states are published at once.  So a run reads only
  the days that changed, the grain stays one row per key, and full, monthly and
  incremental runs may be mixed on one root.
* Marts (``on_touch="append"``): each batch's own aggregates are added, once; ``read_appended``
  merges them to one row a grain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmart.operators import marts
from tripmart.operators.enrich import check_zones
from tripmart.plans.jobs import CUBE_DIR, TableOwnedError, curate_and_validate, guard_layout, guard_marts
from tripmart.schemas import BATCH_COLUMN, CBD_FEE, CURATED_ANY_LAYOUT, CURATED_PARTITIONS
from tripmart.session import with_job_settings, work_dir
from tripmart.sinks import write_table
from tripmart.sinks.fs import children, exists, has_files, remove
from tripmart.sinks.publish import Publication, is_published, recover
from tripmart.sources.ledger import (
    FILE,
    FILE_TYPES,
    LEDGER,
    METADATA,
    file_key,
    files_not_taken,
    gone_files,
    has_tombstones,
    ledger_path,
    listed_files,
    listed_now,
    live_files,
    next_generation,
)
from tripmart.sources.mixed import raw_scans
from tripmart.sources.states import STATES, day_states, days_of, folder, recorded_states, states_frame
from tripmart.sources.tables import scan_curated

# Files per micro-batch: a backfill of a large landing zone runs as a series
# of bounded batches (each replayable on its own), not as one huge batch.
MAX_FILES_PER_TRIGGER = 10_000
# Days made again in one publication.
MAX_DAYS = 1_000
# Partials of appended batches, merged on read.
APPENDED_DIR = "_appended_partials"
CURATED_STREAM = CURATED_ANY_LAYOUT
# The raw file, in its state, of each curated row: kept in incremental tables so that its rows can be taken back.
SOURCE = "_source"
FILE_COLUMN = "_file"
LISTING = "path string, modificationTime timestamp, length long, content binary"
CURATED_SOURCED = StructType([*CURATED_STREAM.fields, StructField(SOURCE, StringType())])


def with_file(raw: DataFrame) -> DataFrame:
    """Rows of a file scan with the file they come from."""
    return raw.select("*", F.struct(*[F.expr(m).alias(c) for c, m in METADATA.items()]).alias(FILE_COLUMN))


class CheckpointMismatch(RuntimeError):
    pass


class RetractedInputError(RuntimeError):
    pass


def guard_checkpoint(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Refuse a fresh checkpoint on an output that already holds data.

    Batch ids restart at 0 with a new checkpoint; pointed at old output,
    they would overwrite batches of the earlier run.
    """
    if not has_files(spark, f"{checkpoint.rstrip('/')}/offsets") and has_files(spark, out):
        raise CheckpointMismatch(
            f"checkpoint {checkpoint} is new but output {out} is not empty; "
            "use a new output directory with a new checkpoint"
        )


def _run(stream: DataFrame, fn, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise query.exception()


@with_job_settings
def refresh_curated(
    spark: SparkSession,
    raw_root: str,
    out: str,
    checkpoint: str,
    use_cbd_fee: bool = False,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
) -> list[dict]:
    """Bring the curated table up to date with the landing; returns per-batch counts.

    Rows of raw files that are gone or were replaced are taken back, new
    files are curated in bounded batches, and files that the stream
    passes over (a known name with other contents) are curated as a correction.
    """
    guard_layout(spark, out, incremental=True)
    guard_checkpoint(spark, out, checkpoint)
    recover(spark, out)
    guard_ledger(spark, out)
    scratch = work_dir(spark, "landing-compared")
    try:
        listed = _kept(listed_files(spark, raw_root), f"{scratch}/listed")
        take_back(spark, listed, out, f"{scratch}/gone")
        return _take_new(spark, raw_root, listed, out, checkpoint, use_cbd_fee, max_files_per_trigger, f"{scratch}/rest")
    finally:
        remove(spark, scratch)


def _take_new(spark: SparkSession, raw_root: str, listed: DataFrame, out: str, checkpoint: str, use_cbd_fee: bool,
              max_files_per_trigger: int, scratch: str) -> list[dict]:
    """Curate what the stream finds new, and then what it passed over."""
    reports: list[dict] = []
    # The stream is one of the files' listing: it tells which are new, and their contents are read by a scan.
    stream = (
        spark.readStream.format("binaryFile").schema(LISTING)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(raw_root)
        .select(*[F.expr(m).alias(c) for c, m in METADATA.items()])
    )

    def batch(df: DataFrame, batch_id: int) -> None:
        key = f"curate-{batch_id}"
        if not is_published(spark, out, key):  # else the batch was done before a failure
            reports.append(_publish_curated(spark, raw_root, df.collect(), out, use_cbd_fee, batch_id, key))

    _run(stream, batch, checkpoint)
    rest = _kept(files_not_taken(live_files(spark, out), listed), scratch).collect()
    for i in range(0, len(rest), max_files_per_trigger):
        reports.append(_publish_curated(spark, raw_root, rest[i:i + max_files_per_trigger], out, use_cbd_fee))
    return reports


def guard_ledger(spark: SparkSession, out: str) -> None:
    """Refuse batches written without a ledger: what they hold can't be told."""
    if any(n.startswith(f"{BATCH_COLUMN}=") for n in children(spark, out)) and not exists(spark, ledger_path(out)):
        raise TableOwnedError(f"{out} holds batches without a ledger of their files; rebuild it into another folder")


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Written once, so that later steps see the same rows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _publish_curated(spark: SparkSession, raw_root: str, files: list, out: str, use_cbd_fee: bool,
                     batch_id: int | None = None, key: str | None = None) -> dict:
    """Curate given files (a batch's bound of them) into ``out/batch_id=N/``, together with their ledger entries.

    Without a batch's number the rows are a correction, numbered by its publication, negative.
    """
    with Publication(spark, out, key) as pub:
        batch_id = pub.correction_number() if batch_id is None else batch_id
        entries = spark.createDataFrame([tuple(f) for f in files], FILE_TYPES)
        there = listed_now(entries, raw_root)  # a file replaced since it was listed is for the next run
        obs = Observation(f"curate_batch_{batch_id}")
        counts = {"input_rows": 0, "valid_rows": 0}
        if there:
            scans = [with_file(r) for r in raw_scans(spark, raw_root, (CBD_FEE,) if use_cbd_fee else (), [f.path for f in there])]
            valid = curate_and_validate(scans, obs, use_cbd_fee, keep=(FILE_COLUMN,))
            source = file_key(*[F.col(f"{FILE_COLUMN}.{c}") for c in FILE])
            tagged = valid.withColumns({BATCH_COLUMN: F.lit(batch_id).cast("long"), SOURCE: source}).drop(FILE_COLUMN)
            pub.write(tagged, "", [BATCH_COLUMN, *CURATED_PARTITIONS], mode="dynamic")
            counts = obs.get
        taken = spark.createDataFrame([tuple(f) for f in there], FILE_TYPES)
        _publish_entries(pub, taken.withColumns({BATCH_COLUMN: F.lit(batch_id).cast("long"), "live": F.lit(True)}), out)
        pub.commit()
    return {"batch_id": batch_id, **counts}


def _publish_entries(pub: Publication, entries: DataFrame, out: str) -> None:
    generation = next_generation(pub.spark, out)
    pub.write(entries.select(*FILE, BATCH_COLUMN, "live", F.lit(generation).alias("generation")), LEDGER, ["generation"], mode="dynamic")


def take_back(spark: SparkSession, listed: DataFrame, out: str, scratch: str) -> int:
    """Remove the rows of raw files that are not ``listed`` any more, or not the same; returns how many files.

    Only the day partitions that hold such rows are written again, without them. They, the days
    that lose all rows and the ledger's tombstones are published at once, so a
    cut short run leaves the table as it was, and the next one takes them back.
    """
    gone = _kept(gone_files(live_files(spark, out), listed), scratch)
    if gone.isEmpty():
        return 0
    rows = spark.read.schema(CURATED_SOURCED).parquet(out)
    dead = gone.select(file_key(*[F.col(c) for c in FILE]).alias(SOURCE))
    # their rows may have moved on to compacted batches, which the ledger does not name
    batches = {r[0] for r in gone.select(BATCH_COLUMN).distinct().collect()} | compacted_batches(spark, out)
    # of the batches' rows only the file names are read here
    hit = rows.where(F.col(BATCH_COLUMN).isin(sorted(batches))).join(dead, SOURCE, "left_semi").select(BATCH_COLUMN, *CURATED_PARTITIONS).distinct()
    days = {tuple(r) for r in hit.collect()}  # batches and days of the calendar
    parts = [BATCH_COLUMN, *CURATED_PARTITIONS]
    within = rows.where(F.col(BATCH_COLUMN).isin(sorted(batches)) & partitions_in(CURATED_PARTITIONS, {d[1:] for d in days}))
    hits = spark.createDataFrame(sorted(days), "batch_id long, year int, month int, day int")
    kept = within.join(F.broadcast(hits), parts, "left_semi").join(dead, SOURCE, "left_anti")
    with Publication(spark, out) as pub:
        if days:
            pub.write(kept, "", parts, mode="dynamic")
            pub.drop("", [folder(d, parts) for d in days])
        _publish_entries(pub, gone.withColumn("live", F.lit(False)), out)
        pub.commit()
    return gone.count()


def compacted_batches(spark: SparkSession, out: str) -> set[int]:
    """Batches that the ledger does not name: written by compactions."""
    prefix = f"{BATCH_COLUMN}="
    there = {int(n.removeprefix(prefix)) for n in children(spark, out) if n.startswith(prefix)}
    return {b for b in there if b < 0} - {r[0] for r in live_files(spark, out).where("batch_id < 0").select(BATCH_COLUMN).distinct().collect()}


def write_curated_batch(raw: DataFrame, batch_id: int, out: str, use_cbd_fee: bool = False) -> dict:
    """Curate rows into ``out/batch_id=N/``; replaying N replaces the days it holds."""
    obs = Observation(f"curate_batch_{batch_id}")
    valid = curate_and_validate(raw, obs, use_cbd_fee)
    tagged = valid.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
    write_table(tagged, out, [BATCH_COLUMN, *CURATED_PARTITIONS], mode="dynamic")
    return {"batch_id": batch_id, **obs.get}


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """The curated table written by ``refresh_curated``, without batch ids."""
    return scan_curated(spark, root)


def partitions_in(names: list[str], values: Iterable[tuple]) -> Column:
    """Rows in one of the given partitions (year, month and perhaps day).

    One set of numbers over partition columns alone, so the scan's partition
    filter takes it, and planning doesn't slow down with the number of days.
    """
    key = F.lit(0)
    for n in names:
        key = key * F.lit(100) + F.col(n).cast("int")
    numbers = set()
    for v in values:
        number = 0
        for x in v:
            number = number * 100 + int(x)
        numbers.add(number)
    return key.isin(sorted(numbers))


@with_job_settings
def refresh_aggregates(
    spark: SparkSession,
    curated_root: str,
    zones: DataFrame,
    out_root: str,
    checkpoint: str,
    on_touch: str = "recompute",
    tables: tuple[str, ...] = tuple(marts.MARTS),
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    max_days: int = MAX_DAYS,
) -> list[int]:
    """Bring the marts up to date with the curated table; returns the publications or batches made.

    ``recompute``: the days whose state differs from the one their partials were made from.
    ``append``: the curated files that the stream has not seen before.
    """
    if on_touch not in ("recompute", "append"):
        raise ValueError(f"on_touch must be 'recompute' or 'append', got {on_touch!r}")
    zone_rows = check_zones(zones)
    if on_touch == "append":
        guard_checkpoint(spark, out_root, checkpoint)
        return _append_batches(spark, curated_root, zones, zone_rows, out_root, checkpoint, tables, max_files_per_trigger)
    guard_marts(spark, out_root, curated_root)
    recover(spark, out_root)
    # listed before anything is read: a day that changes meanwhile stays stale for the next run
    current, known = day_states(spark, curated_root), recorded_states(spark, out_root)
    stale = sorted(d for d in current.keys() | known.keys() if d not in current or known.get(d) != current[d])
    return [
        _recompute_days(spark, curated_root, zones, zone_rows, out_root, tables, stale[i:i + max_days], current)
        for i in range(0, len(stale), max_days)
    ]


def _recompute_days(spark: SparkSession, curated_root: str, zones: DataFrame, zone_rows: int, out_root: str,
                    tables: tuple[str, ...], days: list[tuple], current: dict) -> int:
    """Partials of the days made again, every mart partition that holds one rolled up, all published at once."""
    with Publication(spark, out_root, write=write_table) as pub:
        pub.info["curated_root"] = curated_root
        # 1. Partials of the stale days from all their curated trips.
        trips = scan_curated(spark, curated_root).where(partitions_in(CURATED_PARTITIONS, days))
        cube = marts.with_date_parts(marts.partials(trips, marts.CUBE_KEYS), CURATED_PARTITIONS)
        pub.write(cube, CUBE_DIR, CURATED_PARTITIONS, mode="dynamic")
        made = days_of(pub.partitions(CUBE_DIR))
        pub.drop(CUBE_DIR, [folder(d) for d in days if d not in made])
        fresh = spark.read.schema(cube.schema).parquet(pub.path(CUBE_DIR))
        # 2. The marts' partitions from them and from the other days' partials, which are as the curated table is.
        parts = fresh
        if exists(spark, f"{out_root}/{CUBE_DIR}"):
            others = spark.read.schema(cube.schema).parquet(f"{out_root}/{CUBE_DIR}").where(~partitions_in(CURATED_PARTITIONS, days))
            parts = fresh.unionByName(others)
        for name in tables:
            grain = marts.MART_PARTITIONS[name]
            touched = {d[: len(grain)] for d in days}
            table = marts.marts_from_cube(parts.where(partitions_in(grain, touched)), zones, zone_rows)[name]
            pub.write(table, name, grain, mode="dynamic")
            pub.drop(name, [folder(t, grain) for t in touched])
        # 3. What they were made from.
        known = {d: s for d, s in recorded_states(spark, out_root).items() if d not in set(days)}
        pub.write(states_frame(spark, known | {d: current[d] for d in days if d in current}), STATES)
        return pub.commit()


def _append_batches(spark: SparkSession, curated_root: str, zones: DataFrame, zone_rows: int, out_root: str,
                    checkpoint: str, tables: tuple[str, ...], max_files: int) -> list[int]:
    """Each batch's own aggregates and partials added once: a batch that is published is passed over."""
    if has_tombstones(spark, curated_root) or compacted_batches(spark, curated_root):
        raise RetractedInputError(f"rows were taken back from {curated_root} or moved; appended marts can't follow, use on_touch='recompute'")
    batches: list[int] = []
    stream = spark.readStream.schema(CURATED_STREAM).option("maxFilesPerTrigger", max_files).parquet(curated_root)
    owner = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def batch(df: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        append_batch(df.drop(BATCH_COLUMN), f"append-{owner}-{batch_id}", zones, zone_rows, out_root, tables)

    _run(stream, batch, checkpoint)
    return batches


def append_batch(trips: DataFrame, key: str, zones: DataFrame, zone_rows: int | None, out_root: str,
                 tables: tuple[str, ...] = tuple(marts.MARTS)) -> bool:
    """Add one batch's aggregates to the marts unless ``key`` is published already; says whether it was added."""
    spark = trips.sparkSession
    recover(spark, out_root)
    if is_published(spark, out_root, key):
        return False
    with Publication(spark, out_root, key) as pub:
        cube = marts.with_date_parts(marts.partials(trips, marts.CUBE_KEYS), CURATED_PARTITIONS)
        pub.write(cube, APPENDED_DIR, CURATED_PARTITIONS, mode="append")
        parts = spark.read.schema(cube.schema).parquet(pub.path(APPENDED_DIR))
        for name, table in marts.marts_from_cube(parts, zones, zone_rows).items():
            if name in tables:
                pub.write(table, name, marts.MART_PARTITIONS[name], mode="append")
        pub.commit()
    return True


def read_appended(spark: SparkSession, out_root: str, zones: DataFrame) -> dict[str, DataFrame]:
    """The marts of an appended root with one row a grain: the batches' partials merged, means included."""
    example = marts.with_date_parts(marts.partials(spark.createDataFrame([], CURATED_ANY_LAYOUT), marts.CUBE_KEYS), CURATED_PARTITIONS)
    parts = spark.read.schema(example.schema).parquet(f"{out_root}/{APPENDED_DIR}")
    return marts.marts_from_cube(parts, zones, check_zones(zones))


def refresh_all(
    spark: SparkSession,
    raw_root: str,
    zones: DataFrame,
    curated_root: str,
    curated_checkpoint: str,
    marts_root: str,
    marts_checkpoint: str,
) -> dict[str, list]:
    """New raw files -> curated -> marts; the second step runs only if the first succeeded."""
    first = refresh_curated(spark, raw_root, curated_root, curated_checkpoint)
    second = refresh_aggregates(spark, curated_root, zones, marts_root, marts_checkpoint)
    return {"curate": first, "aggregate": second}
