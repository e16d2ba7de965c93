"""Exact duplicates by an extendible-hash index on shared files.

1. Each task first joins equal texts of its own rows (by their bytes), so a
   group that fills a third of the table reaches the index as a few rows.
2. The 64-bit hash space is cut into equal key ranges. An owner task takes the
   ranges dealt to it, sorted by hash, and fills an extendible-hash index for
   each: a text is looked up in its bucket, where texts of equal hash are chained and told
   apart by comparing bytes, and counted there or added. A bucket that holds more than its capacity splits,
   and the directory doubles when the bucket is as deep as the directory.
3. A finished range is written to the shared folder (one file of buckets with
   its directory), and its entries become rows. Documents take their answer
   by the text's SHA-256 and length; only groups over a fixed share of all
   rows are broadcast (at most HOT_KEYS), the rest is joined by shuffle.

Defined results: null counts as the empty text; the row with the largest
doc_id stays, a null doc_id is smaller than any other; repeated rows (same
doc_id and text) are members of one group, and each gets its row back; empty
tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import get_file, join_hot, put_file, scratch_dir
from tripmart.sinks.fs import qualified

BUCKET_ROWS = 512
#: Rows of text a map task holds before it passes on what it has joined.
COMBINE_BYTES = 24 << 20
ENTRY = pa.schema([("hash", pa.uint64()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("size", pa.int64()), ("chain", pa.int32())])


class ExtendibleIndex:
    """Directory of buckets for the hashes of one key range.

    A slot of the directory is the first ``depth`` bits of the hash below the
    range's own bits. Entries: [hash, sha, keep_id, size, chain].
    """

    def __init__(self, skip_bits: int, capacity: int = BUCKET_ROWS):
        self.skip, self.capacity, self.depth = skip_bits, capacity, 0
        self.buckets: list[tuple[int, list[list]]] = [(0, [])]
        self.directory = [0]
        self.chain: tuple[int | None, list[str]] = (None, [])

    def slot(self, h: int) -> int:
        return ((h << self.skip) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.depth) if self.depth else 0

    def add(self, h: int, text: str, keep_id: int | None, size: int) -> None:
        """Count a text in its bucket: with the entry of its hash whose bytes are the same, or as a new one.

        Texts come in the order of their hashes: a chain is the end of its bucket, and only its texts are held.
        """
        if self.chain[0] != h:
            self.chain = (h, [])
        for e in reversed(self.buckets[self.directory[self.slot(h)]][1]):
            if e[0] != h:
                break
            if self.chain[1][e[4]] == text:  # strings of one encoding: the same bytes
                e[2] = keep_id if e[2] is None else e[2] if keep_id is None else max(e[2], keep_id)
                e[3] += size
                return
        self.insert([h, hashlib.sha256(text.encode()).digest(), keep_id, size, len(self.chain[1])])
        self.chain[1].append(text)

    def entries(self) -> Iterator[list]:
        for _, bucket in self.buckets:
            yield from bucket

    def insert(self, entry: list) -> None:
        at = self.directory[self.slot(entry[0])]
        self.buckets[at][1].append(entry)
        self._split(at)

    def _split(self, at: int) -> None:
        local, entries = self.buckets[at]
        # equal hashes can't be parted, however deep: they stay as one chain
        if len(entries) <= self.capacity or local + self.skip >= 63 or entries[0][0] == entries[-1][0]:
            return
        if local == self.depth:
            self.directory = [b for b in self.directory for _ in (0, 1)]
            self.depth += 1
        slots = [i for i, b in enumerate(self.directory) if b == at]
        upper = set(slots[len(slots) // 2:])
        low = [e for e in entries if self.slot(e[0]) not in upper]
        high = [e for e in entries if self.slot(e[0]) in upper]
        self.buckets[at] = (local + 1, low)
        self.buckets.append((local + 1, high))
        new = len(self.buckets) - 1
        for i in upper:
            self.directory[i] = new
        self._split(at)
        self._split(new)

    def to_bytes(self) -> bytes:
        """Arrow file: one batch a bucket; directory, depth and skipped bits in the schema."""
        meta = {"directory": np.array(self.directory, "<u4").tobytes(), "depth": str(self.depth), "skip": str(self.skip)}
        sink = io.BytesIO()
        with pa.ipc.new_file(sink, ENTRY.with_metadata(meta)) as w:
            for _, entries in self.buckets:
                cols = list(zip(*entries)) or [()] * len(ENTRY)
                w.write_batch(pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, ENTRY)], schema=ENTRY.with_metadata(meta)))
        return sink.getvalue()


def look_up(index_path: str, h: int, sha: bytes, range_bits: int) -> tuple[int, int] | None:
    """(keep_id, group size) of a text by its hash and SHA-256 in a written index: reads one bucket."""
    data = get_file(f"{index_path}/range-{h >> (64 - range_bits) if range_bits else 0:08d}.arrow")
    if data is None:
        return None
    f = pa.ipc.open_file(pa.BufferReader(data))
    meta = f.schema.metadata
    skip, depth = int(meta[b"skip"]), int(meta[b"depth"])
    slot = ((h << skip) & 0xFFFFFFFFFFFFFFFF) >> (64 - depth) if depth else 0
    for e in f.get_batch(int(np.frombuffer(meta[b"directory"], "<u4")[slot])).to_pylist():
        if e["hash"] == h and e["sha"] == sha:
            return e["keep_id"], e["size"]
    return None


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Equal texts of a task become one row; what is held is passed on at COMBINE_BYTES."""
    held: dict[tuple[int, str], list] = {}
    size = 0

    def flush() -> pd.DataFrame:
        out = pd.DataFrame([(h, t, v[0], v[1]) for (h, t), v in held.items()], columns=["h", "text", "keep_id", "size"])
        return out.astype({"h": "int64", "keep_id": "Int64", "size": "int64"})

    for b in batches:
        for h, text, doc_id in zip(b["h"].tolist(), b["text"].tolist(), b["doc_id"].astype("Int64").tolist()):
            at = held.get((h, text))
            if at is None:
                held[h, text] = [None if doc_id is pd.NA else doc_id, 1]
                size += 4 * len(text) + 200
                if size > COMBINE_BYTES:
                    yield flush()
                    held, size = {}, 0
            else:
                at[1] += 1
                if doc_id is not pd.NA and (at[0] is None or doc_id > at[0]):
                    at[0] = doc_id
    if held:
        yield flush()


def _owner(index_path: str, range_bits: int):
    """Fill the indexes of a partition's key ranges from rows sorted by hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: ExtendibleIndex | None = None
        now: int | None = None

        def finished() -> pd.DataFrame:
            """The range's index goes to the shared folder, and its entries become rows."""
            rows = []
            if index is not None:
                put_file(f"{index_path}/range-{now:08d}.arrow", index.to_bytes())
                rows = [(e[1].hex(), e[2], e[3], e[4]) for e in index.entries()]
            return pd.DataFrame(rows, columns=["sha", "keep_id", "size", "chain"]).astype({"keep_id": "Int64"})

        for b in batches:
            for h, text, keep, size in zip(b["h"].tolist(), b["text"].tolist(), b["keep_id"].astype("Int64").tolist(), b["size"].tolist()):
                u = h & 0xFFFFFFFFFFFFFFFF
                owner = u >> (64 - range_bits) if range_bits else 0
                if owner != now:
                    yield finished()
                    index, now = ExtendibleIndex(range_bits), owner
                index.add(u, text, None if keep is pd.NA else keep, size)
        yield finished()

    return run


def build_index(docs: DataFrame, index_path: str, range_bits: int) -> DataFrame:
    """Index the texts of docs (doc_id, text); one row per text: sha, keep_id, size, chain."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("h", F.xxhash64("text"))
    reps = keyed.mapInPandas(_combine, "h long, text string, keep_id long, size long")
    owner = F.shiftrightunsigned("h", 64 - range_bits) if range_bits else F.lit(0)
    # signed order within a range is the order of its hashes
    dealt = reps.withColumn("owner", owner).repartition("owner").sortWithinPartitions("owner", "h")
    return dealt.mapInPandas(_owner(index_path, range_bits), "sha string, keep_id long, size long, chain int")


def exact_dedup(docs: DataFrame, index_path: str | None = None, range_bits: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256 per row: doc_id and these columns.

    ``range_bits``: 2**range_bits key ranges; by default four or more for each shuffle partition.
    The columns of docs named in ``carry`` go along.
    """
    spark = docs.sparkSession
    if range_bits is None:
        range_bits = max(2, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    index_path = qualified(spark, index_path) if index_path else scratch_dir(spark, "exact_index")
    path = f"{scratch_dir(spark, 'exact_groups')}/groups.parquet"
    build_index(docs, index_path, range_bits).write.parquet(path)
    groups = spark.read.schema("sha string, keep_id long, size long, chain int").parquet(path).select("sha", "keep_id", "size")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256).alias("text_sha256"), *carry)
    out = join_hot(rows, groups.withColumnRenamed("sha", "text_sha256"), "text_sha256", "size")
    return out.select("doc_id", "keep_id", F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", *carry)
