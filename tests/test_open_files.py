"""Partitioned writes: few directories side by side without a sort, many by Spark's sort in bounded pieces, the same rows either way; their files listed."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tripmart.session import settings
from tripmart.sinks import ADVISORY, DEALT, OPEN_FILES, PIECE, fs, write_table

OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def test_partitioned_write_opens_files_side_by_side_and_gives_the_setting_back(spark, scratch, monkeypatch):
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append(int(spark.conf.get(OPEN)))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(OPEN)
    rows = spark.range(100).withColumn("month", F.col("id") % 3)
    write_table(rows, f"{scratch}/t", ["month"])
    write_table(rows, f"{scratch}/u")
    assert seen == [OPEN_FILES, int(before)] and spark.conf.get(OPEN) == before


def test_setting_is_given_back_after_a_write_that_fails(spark, scratch):
    before = spark.conf.get(OPEN)
    bad = spark.range(4).select("id", F.raise_error(F.lit("no")).cast("int").alias("month"))
    with pytest.raises(Exception, match="no"):
        write_table(bad, f"{scratch}/t", ["month"])
    assert spark.conf.get(OPEN) == before


@pytest.mark.parametrize("directories", [1, OPEN_FILES, 5 * OPEN_FILES])
def test_rows_and_files_are_the_same_for_few_and_many_directories(spark, scratch, directories):
    """All rows in one task, directories interleaved, one of them for null."""
    month = F.when(F.col("id") % directories > 0, F.col("id") % directories)
    rows = spark.range(0, 2000, 1, 1).select("id", month.cast("int").alias("month")).coalesce(1)
    write_table(rows, f"{scratch}/t", ["month"])
    back = spark.read.schema("id long, month int").parquet(f"{scratch}/t")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert len(glob.glob(f"{scratch}/t/month=*/*.parquet")) == len(glob.glob(f"{scratch}/t/month=*")) == directories


def _writes(monkeypatch) -> list[tuple[str, str]]:
    """The largest piece and the plan of each write."""
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        seen.append((self._df.sparkSession.conf.get(ADVISORY), self._df._jdf.queryExecution().executedPlan().toString()))
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_pieces_that_are_sorted_are_bounded_and_a_lesser_bound_stays(spark, scratch, monkeypatch):
    seen, before = _writes(monkeypatch), spark.conf.get(ADVISORY)
    rows = spark.range(100).withColumn("month", F.col("id") % 3)
    for i, size in enumerate(("64MB", "1g", "8m", "1024", "5kb")):
        with settings(spark, {ADVISORY: size}):
            write_table(rows, f"{scratch}/{i}", ["month"])
            assert spark.conf.get(ADVISORY) == size
    assert [int(s.removesuffix("b")) for s, _ in seen] == [PIECE, PIECE, 8 << 20, 1024, 5 << 10]
    assert spark.conf.get(ADVISORY) == before


def test_rows_are_sent_to_few_partitions_whatever_the_session_has(spark, scratch, monkeypatch):
    """More than Spark's threshold, and every task sorts its wide rows before it sends them."""
    seen = _writes(monkeypatch)
    with settings(spark, {"spark.sql.shuffle.partitions": "1000"}):
        write_table(spark.range(100).withColumn("month", F.col("id") % 3), f"{scratch}/t", ["month"])
    threshold = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    assert DEALT <= threshold and f", {DEALT}), REBALANCE_PARTITIONS_BY_COL" in seen[0][1]


def test_files_are_listed_without_their_permissions(spark, scratch, monkeypatch):
    """Asked for a file's status with its places, a local folder starts a process for its permissions."""

    class Quick:
        def __init__(self, of):
            self.of = of

        def __getattr__(self, name):
            assert name not in ("listFiles", "listLocatedStatus")
            return getattr(self.of, name)

    names = ["a=1/b=x%20y/part-0.parquet", "a=1/b=#é/part-1.parquet", "a=2/b=1/part 2.parquet", "a=2/b=1/_SUCCESS", "a=2/b=1/.part-3.parquet.crc", "plain"]
    for n in names:
        os.makedirs(os.path.dirname(f"{scratch}/t/{n}"), exist_ok=True)
        open(f"{scratch}/t/{n}", "w").close()
    os.makedirs(f"{scratch}/empty")
    plain = fs._fs_path
    monkeypatch.setattr(fs, "_fs_path", lambda *a: (Quick(plain(*a)[0]), plain(*a)[1]))
    assert sorted(fs.files_below(spark, f"{scratch}/t")) == sorted([*names[:3], "plain"])
    assert fs.files_below(spark, f"{scratch}/empty") == fs.files_below(spark, f"{scratch}/none") == []
