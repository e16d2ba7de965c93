"""Table scans: landed raw trips, curated trips, zone CSV, catalog tables.

Raw trips are read in the types their files have; all other scans carry an
explicit schema. Month targeting is a filter on partition columns, which
Spark turns into partition pruning (``PartitionFilters`` in the plan).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripmart.schemas import BATCH_COLUMN, CURATED_ANY_LAYOUT, RAW, RAW_LANDED, RAW_PARTITIONS, ZONE


def landed_schema(spark: SparkSession, root: str, extra: tuple[StructField, ...] = ()) -> StructType:
    """The raw columns under ``root`` in the types of its files (one footer is read).

    A landing may hold ids as bigint or money as decimal; curation casts
    them. Columns that the footer lacks, and ``extra`` ones, take their
    declared type and read as null; an empty landing has the declared types.
    """
    try:
        found = {f.name: f for f in spark.read.parquet(root).schema.fields}
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        found = {}
    partitions = RAW_PARTITIONS.fieldNames()
    data = [found.get(f.name, f) for f in (*RAW.fields, *extra)]
    return StructType(data + [f for f in RAW_LANDED.fields if f.name in partitions])


def scan_raw(spark: SparkSession, root: str, schema: StructType | None = None,
             extra: tuple[StructField, ...] = ()) -> DataFrame:
    """Raw trips under ``root/year=Y/month=M/``; partition columns included.

    Without ``schema`` the types come from the files; give one for a landing
    whose files differ (bigint, say, reads int files as well).
    """
    return spark.read.schema(schema or landed_schema(spark, root, extra)).parquet(root)


def scan_curated(spark: SparkSession, root: str) -> DataFrame:
    """Curated trips under ``root/year=/month=/day=`` or ``root/batch_id=/year=/...``."""
    return spark.read.schema(CURATED_ANY_LAYOUT).parquet(root).drop(BATCH_COLUMN)


def month_target(year: int | str | None, month: int | str | None) -> tuple[int, int] | None:
    """Parse an optional (year, month) target; both or neither must be given.

    Text like ``"02"`` and integers are both accepted, so zero padding in a
    parameter never misses a partition.
    """
    if year is None and month is None:
        return None
    if year is None or month is None:
        raise ValueError("give both target year and target month, or neither")
    y, m = int(str(year)), int(str(month))
    if not 1 <= m <= 12:
        raise ValueError(f"target month out of range: {month!r}")
    return y, m


def only_month(df: DataFrame, year: int | str | None, month: int | str | None) -> DataFrame:
    """Restrict a year/month-partitioned table to one month (pruned scan)."""
    target = month_target(year, month)
    if target is None:
        return df
    y, m = target
    return df.where((F.col("year") == y) & (F.col("month") == m))


def scan_target_month(spark: SparkSession, root: str, year, month) -> DataFrame:
    return only_month(scan_curated(spark, root), year, month)


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header row, read with a fixed schema."""
    return spark.read.schema(ZONE).option("header", True).csv(path)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    partition_by: list[str] | None = None,
) -> None:
    """Define an external parquet table over ``path`` and discover its partitions."""
    quoted = ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in name.split("."))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {quoted} ({cols}) USING parquet{parts} LOCATION '{location}'")
    if partition_by:
        spark.catalog.recoverPartitions(quoted)


def scan_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def metadata_session(spark: SparkSession) -> SparkSession:
    """A session whose parquet scans answer count, min and max from the files' footers, without reading columns.

    Of the same application; tables are read in it by path.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session
