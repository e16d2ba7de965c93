"""Parquet table writes: replace, append, or replace only the partitions written.

Before a partitioned write the rows are rebalanced on the partition
columns (``REBALANCE`` hint): every task then holds whole partitions, so
each directory gets few files instead of one per task, and AQE splits a
partition that is larger than the advisory size (a hot day) across tasks
and merges small ones.  The write itself is Spark's committer: files
become visible only when the job commits.

Spark sorts a task's rows by directory before it writes them.  A task that holds up to
``OPEN_FILES`` directories, as when months are landed, writes
them side by side instead, without a sort; beyond that Spark sorts the rest.  Wide rows that compress well
take ten to twenty times their shuffled bytes in that sort, so a task gets ``PIECE`` bytes at most.
Rows are dealt to ``DEALT`` partitions, few enough that Spark sends them without a sort on that side either.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tripmart.session import settings

MODES = ("overwrite", "append", "dynamic")
#: Each open file buffers its columns, so these are few.
OPEN_FILES = 8
#: Largest shuffled piece that one task sorts and writes, unless the session has a lesser one.
PIECE = 32 << 20
#: Partitions that rows are dealt to before small ones are merged, whatever the session has for other shuffles. Beyond
#: 200 (``spark.shuffle.sort.bypassMergeThreshold``) tasks sort, and may spill, their wide rows before they send them.
DEALT = 200
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
WRITE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}


def _bytes(size: str) -> int:
    """Bytes of a setting like ``64MB``, ``8m`` or ``1024``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def write_conf(spark: SparkSession) -> dict[str, str]:
    """Settings of a partitioned write."""
    return {**WRITE_CONF, ADVISORY: f"{min(PIECE, _bytes(spark.conf.get(ADVISORY)))}b"}


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    compression: str = "snappy",
) -> None:
    """Write ``df`` as parquet.

    ``mode``: ``overwrite`` replaces the table, ``append`` adds files,
    ``dynamic`` replaces only the partitions present in ``df`` and leaves
    all others untouched (the one-month refresh).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "dynamic" and not partition_by:
        raise ValueError("dynamic partition overwrite needs partition columns")
    out = df.hint("rebalance", DEALT, *partition_by) if partition_by else df
    writer = out.write.option("compression", compression)
    if mode == "dynamic":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, write_conf(df.sparkSession) if partition_by else {}):
        writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per task (used for the small zone dimension)."""
    df.write.mode("overwrite").option("header", True).csv(path)
