"""The joins and components that the text operators share: same rows as plain ones, no task with a hot key."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm.common import connected_components, join_hot


@pytest.fixture
def plain_shuffles(spark):
    """AQE off and 16 partitions: what is asked for is what runs."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def sizes(df):
    # all columns are read, so that no join is left out
    return list(Counter(r[-1] for r in df.withColumn("p", F.spark_partition_id()).collect()).values())


@pytest.mark.parametrize("hot", ["'hot'", "null"])
def test_join_hot_spreads_a_key_of_nine_rows_in_ten(plain_shuffles, hot):
    spark = plain_shuffles
    left = spark.range(40000).repartition(8).select(F.expr(f"if(id % 10 > 0, {hot}, concat('k', id % 3000))").alias("k"), F.col("id"))
    right = left.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = join_hot(left, right, "k", "n")
    assert max(sizes(got)) < 2 * np.median(sizes(got)) and len(sizes(got)) == 16
    want = left.join(right, "k", "left").select("k", "id", "n", "top")
    assert got.exceptAll(want).count() == 0 and got.count() == 40000
    plan = got._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert keys and all("_salt" in k and "_cold_salt" in k for k in keys)


def test_join_hot_of_nothing(spark):
    none = spark.createDataFrame([], "k string, id long")
    right = none.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert join_hot(none, right, "k", "n").count() == 0


def test_components_with_a_hub(plain_shuffles):
    """One node has 20,000 neighbours; chains and pairs beside it."""
    spark = plain_shuffles
    star = spark.range(1, 20001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    chain = spark.range(30000, 30200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    pairs = spark.range(40000, 42000, 2).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    got = {r.node: r.component for r in connected_components(star.union(chain).union(pairs)).collect()}
    assert len(got) == 20001 + 201 + 2000
    assert all(got[i] == 0 for i in range(20001)) and all(got[i] == 30000 for i in range(30000, 30201))
    assert all(got[i] == got[i + 1] == i for i in range(40000, 42000, 2))
