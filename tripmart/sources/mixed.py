"""Landings whose files differ in their columns' types.

Spark merges the footers of all files in one job if their types can be merged.  If
they can't (ids as int and as bigint, money as double and as decimal,
times as text), the footers are read in a second job, which tells each file's
types, and the files are grouped by them: one scan a group.  Each
scan is curated in its own types; the casts of the curation make them one table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tripmart.schemas import RAW, RAW_LANDED, RAW_PARTITIONS
from tripmart.sources.ledger import listed_files

NOT_MERGED = "CANNOT_MERGE_SCHEMAS"
EMPTY = "UNABLE_TO_INFER_SCHEMA"


def _declared(found: StructType | None, extra: tuple[StructField, ...]) -> StructType:
    """The raw columns in the types found; columns that no file has take their declared type and read as null."""
    types = {f.name: f for f in found.fields} if found else {}
    partitions = RAW_PARTITIONS.fieldNames()
    data = [types.get(f.name, f) for f in (*RAW.fields, *extra)]
    return StructType(data + [f for f in RAW_LANDED.fields if f.name in partitions])


def _footers(columns: list[str]):
    """A task's files: path and the Spark types of the named columns, from the footers."""

    def spark_type(column, arrow) -> str:
        import pyarrow.types as t

        if column.physical_type == "INT96" or t.is_timestamp(arrow):
            return "timestamp" if column.physical_type == "INT96" or arrow.tz else "timestamp_ntz"
        if t.is_decimal(arrow):
            return f"decimal({arrow.precision},{arrow.scale})"
        plain = {"bool": "boolean", "int8": "byte", "int16": "short", "int32": "int", "int64": "long", "float": "float",
                 "double": "double", "string": "string", "large_string": "string", "binary": "binary", "date32[day]": "date"}
        return plain[str(arrow)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for path in batch["path"]:
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as f:
                    file = pq.ParquetFile(f)
                    places = {file.schema.column(i).path: i for i in range(len(file.schema.names))}
                    arrow = file.schema_arrow
                    types = {c: spark_type(file.schema.column(places[c]), arrow.field(c).type) for c in columns if c in places}
                out.append((path, json.dumps(types, sort_keys=True)))
            yield pd.DataFrame(out, columns=["path", "types"])

    return run


def file_groups(files: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The ``path`` of files by the types of their columns (as JSON); a scan's paths reach the driver, as Spark's own listings do."""
    parts = max(1, min(4 * files.sparkSession.sparkContext.defaultParallelism, files.count()))
    rows = files.select("path").repartition(parts).mapInPandas(_footers(columns), "path string, types string")
    groups: dict[str, list[str]] = {}
    for r in rows.collect():
        groups.setdefault(r.types, []).append(r.path)
    return {k: sorted(v) for k, v in sorted(groups.items())}


def raw_scans(spark: SparkSession, root: str, extra: tuple[StructField, ...] = (), paths: list[str] | None = None) -> list[DataFrame]:
    """The landing under ``root``, or some of its files, as one scan for each set of types.

    ``paths`` are spelt as ``_metadata.file_path`` spells them.
    """
    def scan(schema: StructType, files: list[str] | None) -> DataFrame:
        return spark.read.option("basePath", root).schema(schema).parquet(*(map(unquote, files) if files else [root]))

    try:
        found = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*(map(unquote, paths) if paths else [root])).schema
    except (PySparkException, Py4JJavaError) as e:  # what a job of the listing raises may come unconverted
        if EMPTY in str(e):
            return [scan(_declared(None, extra), paths)]
        if NOT_MERGED not in str(e):
            raise
    else:
        return [scan(_declared(found, extra), paths)]
    files = spark.createDataFrame([(p,) for p in paths], "path string") if paths else listed_files(spark, root)
    groups = file_groups(files, [f.name for f in (*RAW.fields, *extra)])
    return [scan(_declared(_parsed(types), extra), members) for types, members in groups.items()]


def _parsed(types: str) -> StructType:
    return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in json.loads(types).items()))
