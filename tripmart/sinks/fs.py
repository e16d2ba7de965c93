"""Small file-system helpers over Hadoop's FileSystem (any cluster store)."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Hadoop gives it."""
    fs, p = _fs_path(spark, path)
    return fs.makeQualified(p).toString()


def has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and is not an empty directory."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p)) and len(fs.listStatus(p)) > 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under ``path``; none if it does not exist."""
    fs, p = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch directory this library wrote."""
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or directory; the target's parent is made, the target must not exist."""
    fs, s = _fs_path(spark, source)
    t = _fs_path(spark, target)[1]
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"could not move {source} to {target}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if there is one already."""
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)
    finally:
        stream.close()
    return bytes(data).decode()


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths, relative to ``path``, of all data files below it (names that don't start with ``_`` or ``.``).

    Spark lists them: it asks for no permissions, for which a local folder starts a process a file.
    """
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    root = fs.getFileStatus(p).getPath().toUri().getPath().rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()
    return [unquote(urlparse(f).path).removeprefix(root) for f in found]
