"""Ledger of raw files: which file, in which state, has its rows in which batch of the curated table.

A file counts as itself only with its size and modification time, so one
published again under the same name is another file.  Comparing the
ledger with the landing tells what an increment has to do: files that are gone
or were replaced (their rows must go) and files that are not taken in yet,
whatever a stream remembers of their names.

Entries are written one folder a batch: files of the batch are ``live``.  A
correction adds entries for the files it takes back (tombstones, ``live`` false) under
its own, later generation.  Writing an entry again replaces it, so a
repeated batch or correction leaves the same ledger.  All of it is
DataFrames: listings and ledger may have millions of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.sinks.fs import children, exists

LEDGER = "_ledger"
FILE = ["path", "size", "modified"]
FILE_TYPES = "path string, size long, modified long"
SCHEMA = f"{FILE_TYPES}, batch_id long, live boolean, generation long"
#: FILE as a file scan tells it; times are microseconds, the same in every time zone.
METADATA = {"path": "_metadata.file_path", "size": "_metadata.file_size", "modified": "unix_micros(_metadata.file_modification_time)"}


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """path, size, modified of the data files below ``root``: a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    return files.select(*[F.expr(m).alias(c) for c, m in METADATA.items()])


def file_key(path: Column, size: Column, modified: Column) -> Column:
    """One text for a file in one state, as the rows made from it carry it."""
    return F.concat_ws("#", path, size.cast("string"), modified.cast("string"))


def listed_now(files: DataFrame, root: str) -> list:
    """Those of the given FILE rows that are still there as they were (a batch's bound of rows)."""
    return files.join(listed_files(files.sparkSession, root), FILE, "left_semi").collect()


def ledger_path(out: str) -> str:
    return f"{out.rstrip('/')}/{LEDGER}"


def next_generation(spark: SparkSession, out: str) -> int:
    names = [n for n in children(spark, ledger_path(out)) if n.startswith("generation=")]
    return 1 + max((int(n.split("=")[1]) for n in names), default=0)


def live_files(spark: SparkSession, out: str) -> DataFrame:
    """FILE and batch_id of the files whose rows are in the curated table."""
    if not exists(spark, ledger_path(out)):
        return spark.createDataFrame([], SCHEMA).select(*FILE, "batch_id")
    entries = spark.read.schema(SCHEMA).parquet(ledger_path(out))
    newest = Window.partitionBy(*FILE, "batch_id").orderBy(F.desc("generation"))
    last = entries.withColumn("rank", F.row_number().over(newest)).where("rank = 1 and live")
    return last.select(*FILE, "batch_id")


def has_tombstones(spark: SparkSession, out: str) -> bool:
    return exists(spark, ledger_path(out)) and not spark.read.schema(SCHEMA).parquet(ledger_path(out)).where("not live").isEmpty()


def gone_files(live: DataFrame, listed: DataFrame) -> DataFrame:
    """Live entries whose file is no longer there, or no longer the same."""
    return live.join(listed, FILE, "left_anti")


def files_not_taken(live: DataFrame, listed: DataFrame) -> DataFrame:
    """Landed files that no batch holds."""
    return listed.join(live, FILE, "left_anti")
