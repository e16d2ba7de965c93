"""The touched days of an increment prune its scans to their own files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmart.streaming.incremental import partitions_in


@pytest.mark.parametrize("names, values, files", [
    (["year", "month", "day"], [(2024, 1, 3)], 1),
    (["year", "month", "day"], [(2024, 1, 3), (2023, 12, 3)], 1),
    (["year", "month"], [(2024, 1)], 10),
    (["year", "month"], [], 0),
])
def test_only_the_touched_days_are_read(spark, scratch, names, values, files):
    rows = spark.range(20).select("id", F.lit(2024).alias("year"), (1 + F.col("id") % 2).cast("int").alias("month"), (1 + F.col("id")).cast("int").alias("day"))
    rows.repartition(1).write.partitionBy("year", "month", "day").parquet(f"{scratch}/t")
    df = spark.read.schema(rows.schema).parquet(f"{scratch}/t").where(partitions_in(names, values))
    assert len(df.collect()) == files
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    if "FileScan" in leaf.toString():  # an empty set of days needs no scan at all
        assert leaf.metrics().apply("numFiles").value() == files
    else:
        assert files == 0
