"""Positions of rows in groups, by a range sort of the whole table: no group is held by one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

#: monotonically_increasing_id keeps the row's number in its partition in this many low bits.
ROW_BITS = 33


def sorted_rows(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """df dealt by ranges of (group, order, the row's own number) and written, with ``_at``: partition and place in it."""
    keys = [F.col(c) for c in (group, *order, "_tie")]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return stored(dealt.withColumn("_at", F.monotonically_increasing_id()), name)


def with_positions(df: DataFrame, group: str, order: list[str], position: str, name: str) -> DataFrame:
    """df with ``position`` long: the row's place in its ``group`` by ``order`` (nulls first), gapless from 0.

    ``group`` must not be null; rows that are equal in ``order`` are placed in any order. Neither
    a large group nor many equal rows meet in one task. A group's rows lie together in each partition: their
    place is the place in the partition plus the rows of the group in the partitions before. The table of
    those has a row for each partition and each group. ``df`` is run twice (ranges, then rows): give a stored one.
    """
    rows = sorted_rows(df, group, order, name)
    part = F.shiftright("_at", ROW_BITS)
    runs = rows.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_group").orderBy("_part")) - F.col("_n")
    runs = stored(runs.select("_group", "_part", (before - F.col("_first")).alias("_add")), f"{name}_runs")
    placed = rows.join(runs, (F.col(group) == F.col("_group")) & (part == F.col("_part")))
    return placed.select(*df.columns, (F.col("_at") + F.col("_add")).alias(position))
