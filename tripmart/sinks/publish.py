"""Several tables of one root put in place together.

A job writes its tables aside, under ``root/_staged/<id>/``, and then creates
the next numbered file of ``root/_commits/``.  That file is the decision: before it
exists nothing under ``root`` has changed, and a job that fails leaves
all tables as they were.  Once it exists the tables are moved into place;
if that is cut short, the next publication (or ``recover``) finishes it
first.  Every move can be repeated.

* Conflicts: a job remembers the last number when it starts.  If another
  job has taken the next one meanwhile, the commit is refused and
  what was staged is dropped (``PublishConflict``).
* Exactly once: a publication may carry a key (a stream's batch).  A key that is
  committed stays known, and ``is_published`` tells before any work is done.

The tables keep their plain partitioned layout, so any reader of
parquet folders sees them.  Moves are renames of directories: one for a whole table or a
month or batch that is new, one for each replaced partition.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.sinks import write_table
from tripmart.sinks.fs import children, exists, files_below, move, read_text, remove, write_new

STAGED, COMMITS, KEYS = "_staged", "_commits", "_published_keys"
MODES = ("overwrite", "dynamic", "append")


class PublishConflict(RuntimeError):
    pass


def _join(*parts: str) -> str:
    return "/".join(p for p in parts if p)


def _last(spark: SparkSession, root: str) -> int:
    return max((int(n.split(".")[0]) for n in children(spark, f"{root}/{COMMITS}") if n.endswith(".json")), default=0)


def _record(spark: SparkSession, root: str, number: int) -> dict | None:
    return json.loads(read_text(spark, f"{root}/{COMMITS}/{number:010d}.json")) if number else None


def last_record(spark: SparkSession, root: str) -> dict | None:
    """What the last publication under ``root`` recorded."""
    return _record(spark, root, _last(spark, root))


def _folders_to_move(spark: SparkSession, source: str, target: str) -> list[str]:
    """Staged partition folders to move: as high up as the target has none of their name, else the partitions themselves."""
    found: list[str] = []

    def walk(part: str) -> None:
        below = sorted(n for n in children(spark, _join(source, part)) if "=" in n and not n.startswith(("_", ".")))
        if part and not below:
            found.append(part)
        for name in below:
            inner = _join(part, name)
            if exists(spark, _join(target, inner)):
                walk(inner)
            else:
                found.append(inner)

    walk("")
    return found


def _apply(spark: SparkSession, root: str, record: dict) -> None:
    """Move what a committed publication staged into place; what is moved already is passed over."""
    stage = f"{root}/{STAGED}/{record['stage']}"
    for table, gone in record["drop"].items():
        for part in gone:
            remove(spark, _join(root, table, part))
    for table, (mode, folder) in record["tables"].items():
        source, target = f"{stage}/{folder}", _join(root, table)
        if not exists(spark, source):
            continue
        if mode == "overwrite":
            parts = [""]
        elif mode == "dynamic":
            parts = _folders_to_move(spark, source, target)
        else:
            parts = files_below(spark, source)
        for part in parts:
            old, new = _join(stage, "old", folder, part), _join(target, part)
            if mode != "append" and exists(spark, new):
                # the new partition is still staged, so what stands there is the old one
                remove(spark, old)
                move(spark, new, old)
            move(spark, _join(source, part), new)
    if record.get("key"):
        write_new(spark, f"{root}/{KEYS}/{record['key']}", str(record["number"]))
    remove(spark, stage)


def recover(spark: SparkSession, root: str) -> int:
    """Finish the last committed publication if it was cut short; returns its number."""
    number = _last(spark, root)
    record = _record(spark, root, number)
    if record and exists(spark, f"{root}/{STAGED}/{record['stage']}"):
        _apply(spark, root, record)
    elif record and record.get("key") and not is_published(spark, root, record["key"]):
        write_new(spark, f"{root}/{KEYS}/{record['key']}", str(number))
    return number


def is_published(spark: SparkSession, root: str, key: str) -> bool:
    return exists(spark, f"{root}/{KEYS}/{key}")


class Publication:
    """Stages tables under ``root`` until ``commit``; as a context manager it drops them on an error."""

    def __init__(self, spark: SparkSession, root: str, key: str | None = None, write: Callable | None = None):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.base = recover(spark, self.root)
        self.id = uuid.uuid4().hex[:12]
        self.stage = f"{self.root}/{STAGED}/{self.id}"
        self.tables: dict[str, tuple[str, str]] = {}
        self.gone: dict[str, list[str]] = {}
        self.write_rows = write or write_table
        self.info: dict = {}
        self.done = False

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
        """Stage ``df`` for ``root/table``: as the whole table, the partitions it holds, or rows to add.

        ``table`` may be empty for partitions that lie under ``root`` itself.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        if mode == "dynamic" and not partition_by or mode == "overwrite" and not table:
            raise ValueError(f"{mode} of {table!r} needs {'partition columns' if table else 'a table of its own'}")
        folder = f"table-{len(self.tables)}"
        self.write_rows(df, f"{self.stage}/{folder}", partition_by)
        self.tables[table] = (mode, folder)

    def correction_number(self) -> int:
        """A negative number that no other publication of this root has or will have."""
        return -(self.base + 1)

    def path(self, table: str) -> str:
        """Where a staged table can be read before it is committed."""
        return f"{self.stage}/{self.tables[table][1]}"

    def files(self, table: str) -> list[str]:
        """Files staged for a table, like ``year=2024/month=1/part-0.parquet``."""
        return files_below(self.spark, self.path(table))

    def partitions(self, table: str) -> set[str]:
        """Partition folders staged for a table, like ``year=2024/month=1``."""
        return {f.rpartition("/")[0] for f in self.files(table)}

    def drop(self, table: str, partitions: list[str]) -> None:
        """Partitions that go with the commit, but for those that are staged."""
        self.gone.setdefault(table, []).extend(sorted(partitions))

    def commit(self) -> int:
        number = self.base + 1
        # a cut short commit is applied again: what it drops must not be what it puts in place
        for table in self.gone.keys() & self.tables.keys():
            self.gone[table] = sorted(set(self.gone[table]) - self.partitions(table))
        record = {"number": number, "stage": self.id, "key": self.key, "tables": self.tables, "drop": self.gone, **self.info}
        if not write_new(self.spark, f"{self.root}/{COMMITS}/{number:010d}.json", json.dumps(record)):
            raise PublishConflict(f"another job has published to {self.root} since this one started; run it again")
        self.done = True
        _apply(self.spark, self.root, record)
        return number

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None and not self.done:
            remove(self.spark, self.stage)
