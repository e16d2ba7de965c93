"""Session settings and the shared scratch location.

All intermediate tables (landing copies, round trips, stream checkpoints)
live under the cluster's shared checkpoint directory.  A session that has
none gets a fresh temporary one on a local master, and is refused elsewhere.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC pins wall-clock calendar fields;
# AQE re-plans joins and coalesces/splits shuffle partitions at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # The curation is one wide projection; fused with validation its
    # generated method passes HotSpot's 8000-byte JIT limit and would run
    # interpreted.  Above that size Spark falls back to per-operator code,
    # which is split into small, compiled methods (3-4x faster here).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """A session builder; without arguments the submit decides on master and parallelism."""
    b = SparkSession.builder.appName("tripmart")
    if master is not None:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    return b


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to an existing session."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for some statements; the caller's are given back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        if before[k] != v:
            spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def with_job_settings(job):
    """A job (its first argument is the session) that runs under the settings it relies on and gives the caller's back."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with settings(spark, SESSION_CONF):
            return job(spark, *args, **kwargs)

    return run


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session.

    Read from ``spark.checkpoint.dir`` or the context's checkpoint dir;
    only when neither is set (tests, local runs) is a temporary one made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/tripmart/{app}/{name}-{uuid.uuid4().hex[:12]}"
