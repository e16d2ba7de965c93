"""Helpers shared by the operators of this subpackage.

Scratch tables and index files live under the folder that the session names
in ``spark.checkpoint.dir``; nothing is kept on one machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import work_dir
from tripmart.sinks.fs import qualified, remove

#: ASCII white space, the only characters that separate words here.
SPACES = " \t\n\x0b\x0c\r"
#: Schemes that Arrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
#: Largest table, in rows, that may be broadcast by an explicit hint.
HOT_KEYS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Scratch folders made inside of ``collected_scratch``, innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def collected_scratch() -> Iterator[list[str]]:
    """The scratch folders that are made meanwhile, for one who knows when they have been read last."""
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        _SCOPES.pop()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared one, with the scheme that Spark reads it by."""
    path = qualified(spark, work_dir(spark, name))
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def drop_scratch(spark: SparkSession, folders: list[str], reader: DataFrame) -> list[str]:
    """Remove scratch folders that ``reader`` does not read; returns those that it does."""
    files = [urlparse(f).path for f in reader.inputFiles()]
    used = [d for d in folders if any(f.startswith(urlparse(d).path + "/") for f in files)]
    for d in folders:
        if d not in used:
            remove(spark, d)
    return used


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, name)}/{name}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shared_root(path: str) -> Iterator[tuple[pafs.FileSystem, str]]:
    """File system and path of a shared folder, usable on driver and executors.

    ``scratch_dir`` gives its paths a scheme, so that they are those Spark means; one without is a local file here.
    """
    scheme, _, rest = path.partition(":") if ":" in path.split("/", 1)[0] else ("file", ":", path)
    uri = f"{SCHEMES.get(scheme, scheme)}:{rest if rest.startswith('//') else '//' + rest}"
    try:
        fs, root = pafs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
        raise RuntimeError(f"index files can't be kept under {path}: name a folder in spark.checkpoint.dir that Arrow reads too") from e
    yield fs, root


def put_file(path: str, data: bytes) -> None:
    """Write a whole file under another name, then rename: a retried task may repeat it."""
    import os

    with shared_root(path) as (fs, name):
        fs.create_dir(os.path.dirname(name), recursive=True)
        part = f"{name}.{os.getpid()}-{os.urandom(4).hex()}.part"
        with fs.open_output_stream(part) as f:
            f.write(data)
        fs.move(part, name)


def get_file(path: str) -> bytes | None:
    """The file's bytes; None if there is no such file."""
    with shared_root(path) as (fs, name):
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_file(name) as f:
            return f.read()


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int | None = None) -> DataFrame:
    """Left join on ``key``, unique in ``right``, without one task for a hot key.

    ``weight`` in ``right`` is the number of left rows of each key; ``total`` is an upper bound
    of their sum, counted if not given. Keys that hold over 1/HOT_KEYS of it are at most HOT_KEYS many,
    whatever the input's size: only these are broadcast. All other rows are shuffled by key, and
    no key among them is large; rows that the broadcast has served, and rows without a key, are spread over all tasks.
    """
    values = [c for c in right.columns if c != key]
    if total is None:
        total = right.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("t")).first()["t"]
    hot = right.where(F.col(weight) * HOT_KEYS > F.lit(total))
    hot = hot.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    tagged = left.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    # Both sides are dealt by key and salt. The right's salt is 0, from a column so that Spark does not fold it
    # and drop the salt from the keys; served rows have a salt above 0 by their own number, and find no partner.
    own = 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    cold = right.where(F.col(weight) * HOT_KEYS <= F.lit(total)).select(
        F.col(key).alias("_cold_key"), F.pmod(F.col(weight), F.lit(1)).cast("long").alias("_cold_salt"), F.struct(*values).alias("_cold"))
    tagged = tagged.withColumn("_salt", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(own).cast("long"))
    out = tagged.join(cold, (F.col(key) == F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt")), "left")
    out = out.withColumn("_found", F.coalesce("_hot", "_cold"))
    return out.select(*left.columns, *[F.col(f"_found.{c}").alias(c) for c in values])


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node reachable.

    Alternating large-star and small-star steps: the number of rounds grows
    with the logarithm of the longest path. Each round is written to the shared
    folder. Null ends and self-loops are left out. Only one row of counts a
    round reaches the driver.
    """
    spark = edges.sparkSession
    root = scratch_dir(spark, name)
    e = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def write(df: DataFrame, n: int) -> DataFrame:
        df.write.parquet(f"{root}/round-{n}")
        return spark.read.schema(df.schema).parquet(f"{root}/round-{n}")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e, n = write(e, 0), 0
    before, now = None, state(e)
    while now != before and now[0]:
        # a hub has as many edges as its component has nodes: its least neighbour is broadcast, its edges stay spread
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("w"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "w").alias("m"), "n")
        large = join_hot(both, least, "u", "n", 2 * now[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        joined = join_hot(down, least, "u", "n", 2 * now[0])
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        n += 1
        e = write(small, n)
        before, now = now, state(e)
        remove(spark, f"{root}/round-{n - 1}")  # read for the last time
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(e.select("v", "v").distinct())
