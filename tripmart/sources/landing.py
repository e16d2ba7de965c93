"""Landing-zone operators: land raw months, find the latest month, slice by
run mode, skip what is already landed, and describe what landed.

All of them are table operations on the ``year``/``month`` partition
columns, so Spark answers them from pruned scans; only one-row results
(the latest month) ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.sinks import write_table

MONTH_KEYS = ["year", "month"]


def land_raw(raw: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Write raw trips as ``root/year=Y/month=M/`` parquet.

    ``mode="dynamic"`` replaces only the months present in ``raw``, so
    re-landing a month is idempotent.
    """
    write_table(raw, root, MONTH_KEYS, mode=mode)


def latest_month(raw: DataFrame) -> DataFrame:
    """One row (year, month): the newest month present in the table."""
    newest = raw.agg(F.max(F.struct(*MONTH_KEYS)).alias("m"))
    return newest.select(F.col("m.year").alias("year"), F.col("m.month").alias("month"))


def _latest(raw: DataFrame) -> tuple[int, int] | None:
    row = latest_month(raw).first()
    return None if row is None or row["year"] is None else (row["year"], row["month"])


def month_index() -> Column:
    """Months since year 0: orders (year, month) pairs as one integer."""
    return F.col("year") * 12 + F.col("month")


def slice_current(raw: DataFrame) -> DataFrame:
    """Run mode "current": the latest month only (a pruned partition scan)."""
    latest = _latest(raw)
    if latest is None:
        return raw.where(F.lit(False))
    y, m = latest
    return raw.where((F.col("year") == y) & (F.col("month") == m))


def slice_historical(raw: DataFrame, base_year: int) -> DataFrame:
    """Run mode "historical": from January of ``base_year`` up to, but without,
    the latest month; every year in between is included."""
    latest = _latest(raw)
    if latest is None:
        return raw.where(F.lit(False))
    y, m = latest
    return raw.where((F.col("year") >= base_year) & (month_index() < y * 12 + m))


def months_to_land(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Months present in ``source`` and absent from ``landed``, with their rows.

    Both sides are reduced to one row per month before the anti join, so
    the join never sees individual trips.
    """
    available = source.groupBy(*MONTH_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    present = landed.select(*MONTH_KEYS).distinct()
    return available.join(present, MONTH_KEYS, "left_anti")


def landed_files(table: DataFrame) -> DataFrame:
    """One row per file of a landing scan: its month, name, size and rows."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return table.select(
        *MONTH_KEYS, name.alias("file_name"), F.col("_metadata.file_size").alias("file_size")
    ).groupBy(*MONTH_KEYS, "file_name").agg(F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("rows"))


def landed_contents(table: DataFrame) -> DataFrame:
    """``landed_files`` with a digest of each file's rows, the same in any order and for any number of row groups.

    Sum and exclusive-or of the rows' hashes: equal rows count as often as they stand there.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    columns = [F.col(f"`{c}`") for c in sorted(table.columns) if c not in MONTH_KEYS]
    row = F.xxhash64(*columns)
    hashed = table.select(*MONTH_KEYS, name.alias("file_name"), F.col("_metadata.file_size").alias("file_size"), row.alias("h"))
    digest = F.concat_ws("-", F.sum(F.col("h").cast("decimal(38,0)")).cast("string"), F.bit_xor(F.xxhash64("h")).cast("string"))
    return hashed.groupBy(*MONTH_KEYS, "file_name").agg(
        F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("rows"), digest.alias("digest"))


#: What makes a file the same as a landed one of its month.
SAME_FILE = {"name": ["file_name"], "content": ["rows", "digest"], "both": ["file_name", "rows", "digest"]}


def files_to_land(source: DataFrame, landed: DataFrame, by: str = "name") -> DataFrame:
    """Files offered by ``source`` that are not landed yet.

    ``by``: a file is known by its ``name``, by its ``content`` (whatever its name), or by ``both``, so that one
    published again under its name with other rows is offered again. A
    month that is landed in part still yields its other files. Both sides
    must be file scans, laid out by month; names alone are told from their listing.
    """
    files = landed_files if by == "name" else landed_contents
    keys = [*MONTH_KEYS, *SAME_FILE[by]]
    return files(source).join(files(landed).select(*keys), keys, "left_anti")


def landing_manifest(landed: DataFrame, time_column: str = "pickup_datetime") -> DataFrame:
    """Per landed month: rows, files, bytes and the period the rows cover.

    Rows are first combined per file (``_metadata`` of the parquet scan),
    then per month: two small aggregations, no per-row state.
    """
    per_file = landed.select(
        *MONTH_KEYS,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col(time_column).alias("t"),
    ).groupBy(*MONTH_KEYS, "file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows"), F.min("t").alias("lo"), F.max("t").alias("hi")
    )
    return per_file.groupBy(*MONTH_KEYS).agg(
        F.sum("rows").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size").alias("total_bytes"),
        F.min("lo").alias("first_event"),
        F.max("hi").alias("last_event"),
    )
