"""Lines found in many documents, by a sharded minimal perfect hash.

1. Spark counts, per line key (stripped, ASCII lower case), the documents that
   hold it; keys travel as two 64-bit hashes, pre-aggregated before the shuffle.
2. The hashes of keys found in two documents or more are cut into shards of
   bounded size. Each shard gets a minimal perfect hash (levels of bitmaps:
   a key takes a bit where it is alone, the others go on to the next level),
   whose ranks address two compact arrays: fingerprints and counts. One file
   a shard, in the shared folder.
3. Documents stay where they are: each task hashes its lines and probes the
   shards' arrays, reading a shard only when a line falls into it and holding
   no more than a fixed number of bytes of shards. Lines are never joined.

The perfect hash places a key by both hashes and the fingerprint is the whole
second hash, so two keys are taken for one only if 128 bits agree.

Defined results: null and empty texts have one empty line; keys shorter than
``min_chars`` are never dropped; ``min_docs`` of 1 drops every key long
enough; repeated rows count as documents of their own; empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import SPACES, get_file, lower_ascii, put_file, scratch_dir, stored

SHARD_KEYS = 200_000
#: Bytes of shards a task holds at once.
HELD_BYTES = 64 << 20
GAMMA = 2
U = np.uint64


def mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """64 mixed bits of both hashes for a level."""
    with np.errstate(over="ignore"):
        x = a ^ ((b << U(31)) | (b >> U(33))) ^ U((level * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class PerfectHash:
    """Minimal perfect hash over distinct (a, b) hash pairs with fingerprint and count arrays."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray):
        self.levels, self.prints, self.counts = levels, prints, counts
        self.ranks = []
        base = 0
        for bits in levels:
            c = np.cumsum(bits, dtype=np.uint32)
            self.ranks.append((c, base))
            base += int(c[-1]) if len(c) else 0

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> "PerfectHash":
        levels, left, order = [], np.arange(len(a)), []
        while len(left):
            m = max(64, GAMMA * len(left))
            at = (mix(a[left], b[left], len(levels)) % U(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            own = alone[at]
            bits = np.zeros(m, bool)
            bits[at[own]] = True
            levels.append(bits)
            order.append(left[own][np.argsort(at[own])])
            left = left[~own]
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        return cls(levels, b[order], counts[order])

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Counts of the pairs; 0 for those not in the index."""
        out = np.zeros(len(a), self.counts.dtype)
        left = np.arange(len(a))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = (mix(a[left], b[left], level) % U(len(bits))).astype(np.int64)
            hit = bits[at]
            c, base = self.ranks[level]
            rank = base + c[at[hit]].astype(np.int64) - 1
            found = left[hit]
            same = self.prints[rank] == b[found]
            out[found[same]] = self.counts[rank[same]]
            left = left[~hit]
        return out

    def nbytes(self) -> int:
        return sum(5 * len(x) for x in self.levels) + self.prints.nbytes + self.counts.nbytes

    def to_bytes(self) -> bytes:
        sink = io.BytesIO()
        arrays = {"sizes": np.array([len(x) for x in self.levels], np.int64), "prints": self.prints, "counts": self.counts}
        np.savez(sink, bits=np.packbits(np.concatenate(self.levels) if self.levels else np.zeros(0, bool)), **arrays)
        return sink.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        z = np.load(io.BytesIO(data))
        sizes = z["sizes"]
        bits = np.unpackbits(z["bits"])[: int(sizes.sum())].astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [], z["prints"], z["counts"])


def line_keys(text: Column, min_chars: int) -> Column:
    """Per line struct (a, b) of its key's hashes; null for keys shorter than min_chars."""
    lines = F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n", -1)
    trimmed = F.transform(lines, lambda x: F.btrim(x, F.lit(SPACES)))
    return F.transform(trimmed, lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit("line"), k).alias("b"))))


def build_shards(docs: DataFrame, index_path: str, min_docs: int, min_chars: int) -> tuple[int, set[int]]:
    """Count keys, index those of ``min_docs`` documents or more; the number of shards, and those that hold keys."""
    keys = docs.select(F.explode(F.array_distinct(line_keys(F.col("text").cast("string"), min_chars))).alias("k")).where("k is not null")
    counts = stored(keys.groupBy("k.a", "k.b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs), "line_counts")
    total = counts.count()
    shards = max(1, -(-total // SHARD_KEYS))
    kind = np.uint8 if min_docs <= 255 else np.uint32
    most = np.iinfo(kind).max

    def build(df: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((df["b"], df["a"]))  # a retried task writes the same bytes
        a, b = (df[c].to_numpy()[order].astype(np.int64).view(np.uint64) for c in ("a", "b"))
        index = PerfectHash.build(a, b, np.minimum(df["n"].to_numpy()[order], most).astype(kind))
        put_file(f"{index_path}/shard-{int(df['shard'].iloc[0]):06d}.npz", index.to_bytes())
        return pd.DataFrame({"shard": df["shard"].iloc[:1], "keys": [len(df)]})

    made = counts.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(build, "shard int, keys long")
    written = made.collect()  # a row a shard
    if sum(r["keys"] for r in written) != total:
        raise RuntimeError("the line index is incomplete")
    return shards, {r["shard"] for r in written}


def _probe(index_path: str, shards: int, filled: set[int], min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, PerfectHash | None] = OrderedDict()
        size = 0

        def shard(s: int) -> PerfectHash | None:
            nonlocal size
            if s not in held:
                data = get_file(f"{index_path}/shard-{s:06d}.npz") if s in filled else None
                if data is None and s in filled:
                    raise FileNotFoundError(f"shard {s} of the line index is not in {index_path}: is the folder shared by all executors?")
                held[s] = PerfectHash.from_bytes(data) if data else None
                size += held[s].nbytes() if held[s] else 0
                while size > HELD_BYTES and len(held) > 1:
                    _, old = held.popitem(last=False)
                    size -= old.nbytes() if old else 0
            held.move_to_end(s)
            return held[s]

        for batch in batches:
            keys = batch.column("keys")
            starts = keys.offsets.to_numpy()
            flat = keys.values.slice(starts[0], starts[-1] - starts[0]) if len(starts) else keys.values
            starts = starts - starts[0]
            valid = flat.is_valid().to_numpy(zero_copy_only=False)
            a, b = (flat.field(i).fill_null(0).to_numpy().view(np.uint64) for i in (0, 1))
            drop = np.zeros(len(a), bool)
            part = (a.view(np.int64) % shards).astype(np.int64)
            order = np.argsort(part, kind="stable")
            order = order[valid[order]]
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for group in np.split(order, cuts):
                if len(group) and (index := shard(int(part[group[0]]))):
                    drop[group] = index.get(a[group], b[group]) >= min_docs
            texts = batch.column("text")
            out, dropped = [], np.add.reduceat(np.append(drop, False), starts[:-1]) if len(texts) else np.zeros(0)
            for i in range(len(texts)):
                text = texts[i].as_py() or ""
                if dropped[i]:
                    lines = text.split("\n")
                    text = "\n".join(x for x, d in zip(lines, drop[starts[i]:starts[i + 1]].tolist()) if not d)
                out.append(text)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.diff(starts).astype(np.int64)), pa.array(dropped.astype(np.int64)), pa.array(out, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "text"])

    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines kept) per row of docs (doc_id, text)."""
    index_path = scratch_dir(docs.sparkSession, "line_index")
    shards, filled = build_shards(docs, index_path, min_docs, min_chars)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), line_keys(F.col("text").cast("string"), min_chars).alias("keys"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_probe(index_path, shards, filled, min_docs), f"doc_id {kind}, n_lines long, n_dropped long, text string")
