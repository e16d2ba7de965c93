"""The session builder leaves the cluster's choices alone; scratch folders must be shared."""

from __future__ import annotations

import pytest

from tripmart.session import builder, checkpoint_root
from tripmart.streaming.incremental import partitions_in


def test_builder_sets_neither_master_nor_parallelism():
    options = builder()._options
    assert "spark.master" not in options and "spark.sql.shuffle.partitions" not in options


def test_scratch_needs_a_shared_folder_off_a_local_master():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_touched_days_prune_the_scan(spark, scratch):
    days = spark.range(19).selectExpr("id", "2024 as year", "2 as month", "cast(id + 1 as int) as day")
    days.write.partitionBy("year", "month", "day").parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t").where(partitions_in(["year", "month", "day"], {(2024, 2, 5), (2024, 2, 7)}))
    assert sorted(r.day for r in df.collect()) == [5, 7]
    assert len(df.inputFiles()) >= 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_job_gives_the_callers_settings_back(spark):
    from tripmart.session import SESSION_CONF, with_job_settings

    seen = []

    @with_job_settings
    def job(spark, fails):
        seen.append({k: spark.conf.get(k) for k in SESSION_CONF})
        if fails:
            raise ValueError("stop")

    mine = {"spark.sql.session.timeZone": "Asia/Tokyo", "spark.sql.codegen.hugeMethodLimit": "65535"}
    before = {k: spark.conf.get(k) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        job(spark, False)
        with pytest.raises(ValueError):
            job(spark, fails=True)
        assert {k: spark.conf.get(k) for k in mine} == mine and seen == [SESSION_CONF, SESSION_CONF]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
