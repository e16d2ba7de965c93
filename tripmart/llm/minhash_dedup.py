"""Near duplicates by MinHash and a multi-index Hamming join.

A document's set is its distinct five-word shingles. Documents of equal sets
are one class; only classes go on, so groups of copies cost one row.

1. A class's signature is SYMBOLS MinHash values of 16 bits, in CHUNKS chunks.
   Two signatures with fewer than CHUNKS * (ERRORS + 1) differing symbols
   have, by the pigeonhole principle, a chunk with ERRORS differences at
   most. Enumerating the chunk's allowed errors (leaving out each one symbol)
   gives keys, and such a pair shares a key for certain.
2. Within a key's group, signatures and set sizes tell who can't be similar;
   the rest is tied into candidate cells by a spanning forest, never by all
   pairs. Groups beyond BLOCK are tied to their first member untested, which
   only makes the cell larger. So are groups with a row that stands for others of its task, tied to it there:
   whoever shares a key with them is in their cell. Cells are connected components, found by Spark.
3. Cells are verified on full sets: documents of a cell are dealt to blocks of
   bounded size, each pair of blocks is one group of rows, and each group
   gives a spanning forest of its true links. Every pair of a cell meets in
   one group, so no link that matters to the components is lost.
4. Components of the true links label the classes, and classes the documents.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; fewer words than five are one shingle, the whole sequence;
repeated rows are copies of each other; rows with a null doc_id keep their
class's component (null if all its ids are null); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import connected_components, join_hot, stored

WORDS = 5
SYMBOLS, CHUNK, ERRORS = 32, 4, 1
CHUNKS = SYMBOLS // CHUNK
#: Signatures that differ in more symbols aren't tied; the join guarantees all pairs under 16.
MAX_DIFFERENT = 18
BLOCK = 2048
#: Bounds of a verified block: documents and shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 2_000_000
HELD_WORDS = 500_000
#: Of a key met more often than this within one batch, the further rows are tied to the first one there, which travels for them.
LOCAL_HOT = 64
U = np.uint64


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240601)
    return rng.integers(1, 2**63, SYMBOLS, dtype=np.uint64) | U(1), rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, as bytes lower-cased in ASCII."""

    def __init__(self, words: int = WORDS):
        self.words, self.held = words, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        import xxhash

        words = (text or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.held) > HELD_WORDS:
            self.held = {}
        held = self.held
        for w in set(words).difference(held):
            held[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(h))
        with np.errstate(over="ignore"):
            x = np.full(len(h) - k + 1, k, np.uint64)
            for j in range(k):
                x = (x ^ h[j:len(h) - k + 1 + j]) * U(0x9E3779B97F4A7C15)
                x ^= x >> U(29)
            x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
        return np.unique(x ^ (x >> U(32)))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        low = [((shingles * x + y) >> U(7)).min() for x, y in zip(a, b)]
    return (np.array(low, np.uint64) & U(0xFFFF)).astype("<u2")


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler, (a, b) = Shingler(words), _multipliers()
        for batch in batches:
            n, sets, sigs = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                s = shingler(text.as_py())
                n.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, a, b).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_id", "sig"])

    return run


def keys_of(sigs: np.ndarray) -> np.ndarray:
    """(rows, CHUNKS * CHUNK) keys: each chunk with each one symbol left out."""
    keys = []
    for c in range(CHUNKS):
        for left in range(CHUNK):
            x = np.full(len(sigs), c * CHUNK + left, np.int64)
            for j in range(CHUNK):
                if j != left:
                    x = (x << 16) | sigs[:, c * CHUNK + j].astype(np.int64)
            keys.append(x)
    return np.stack(keys, axis=1)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and key; beyond LOCAL_HOT of a key in a batch, a direct tie to its first member, which stands for them."""
    names = ["key", "rep", "n", "sig", "tie", "stands"]
    for batch in batches:
        if not batch.num_rows:
            continue
        rep, n = (batch.column(c).to_numpy() for c in ("rep", "n"))
        sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
        keys = keys_of(sigs).ravel()
        who = np.repeat(np.arange(len(rep)), CHUNKS * CHUNK)
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], who[order]
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
        hot = np.arange(len(keys)) - start >= LOCAL_HOT
        ties = np.unique(np.stack([rep[who[hot]], rep[who[start[hot]]]], axis=1), axis=0)
        stands = np.zeros(len(keys), bool)
        stands[start[hot]] = True
        stands = stands[~hot]
        short = (sigs >> 8).astype(np.uint8)[who[~hot]]
        for i in range(0, len(short), 50_000):
            w = who[~hot][i:i + 50_000]
            part = np.ascontiguousarray(short[i:i + 50_000])
            blobs = pa.Array.from_buffers(pa.binary(), len(w), [None, pa.py_buffer(np.arange(0, SYMBOLS * (len(w) + 1), SYMBOLS, dtype=np.int32).tobytes()), pa.py_buffer(part.tobytes())])
            yield pa.record_batch([pa.array(keys[~hot][i:i + 50_000]), pa.array(rep[w]), pa.array(n[w]), blobs, pa.nulls(len(w), pa.int64()), pa.array(stands[i:i + 50_000])], names=names)
        if len(ties):
            yield pa.record_batch([pa.array(ties[:, 0]), pa.array(ties[:, 0]), pa.nulls(len(ties), pa.int64()), pa.nulls(len(ties), pa.binary()), pa.array(ties[:, 1]), pa.array(np.zeros(len(ties), bool))], names=names)


def _tie(percent: int):
    """Spanning forests of the groups of rows with equal key, from rows sorted by key."""

    def forest(rep: np.ndarray, n: np.ndarray, sig: np.ndarray) -> list[tuple[int, int]]:
        out, left = [], np.arange(len(rep))
        while len(left) > 1:
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = (sig[left] != sig[at]).sum(axis=1) <= MAX_DIFFERENT
                near &= 100 * np.minimum(n[left], n[at]) >= percent * np.maximum(n[left], n[at])
                out += [(int(rep[at]), int(rep[i])) for i in left[near]]
                queue += left[near].tolist()
                left = left[~near]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, hub = None, [], None  # the group that the last batch has not ended
        for batch in batches:
            edges: list[tuple[int, int]] = []
            tie = batch.column("tie")
            direct = tie.is_valid().to_numpy(zero_copy_only=False)
            edges += zip(batch.column("rep").to_numpy()[direct].tolist(), tie.drop_null().to_pylist())
            rows = batch.filter(pa.array(~direct))
            if rows.num_rows:
                keys, rep, n = (rows.column(c).to_numpy() for c in ("key", "rep", "n"))
                stands = rows.column("stands").to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, SYMBOLS)
                cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
                for i, j in zip(cuts[:-1], cuts[1:]):
                    if keys[i] != key:
                        if held and len(held[0][0]) + sum(len(x[0]) for x in held[1:]) > 1:
                            edges += forest(*(np.concatenate(x) for x in zip(*held)))
                        key, held, hub = keys[i], [], None
                        if j < len(keys):
                            if j - i > BLOCK or stands[i:j].any():
                                edges += [(int(rep[i]), int(x)) for x in rep[i + 1:j]]
                            elif j - i > 1:
                                edges += forest(rep[i:j], n[i:j], sig[i:j])
                            continue
                    if hub is None and (stands[i:j].any() or sum(len(x[0]) for x in held) + j - i > BLOCK):
                        hub = int(held[0][0][0] if held else rep[i])
                        edges += [(hub, int(x)) for h in held for x in h[0]]
                        held = []
                    if hub is not None:
                        edges += [(hub, int(x)) for x in rep[i:j]]
                    else:
                        held.append((rep[i:j], n[i:j], sig[i:j]))
            yield _edges(edges)
        if held:
            yield _edges(forest(*(np.concatenate(x) for x in zip(*held))))

    return run


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*edges) if edges else ((), ())
    return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _shingle(words: int):
    """Full sets; where a doc_id stands in several rows, only a row with its class's set counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler, names = Shingler(words), ["rep", "cell", "blocks", "block"]
        for batch in batches:
            sets = [shingler(t.as_py()).tobytes() for t in batch.column("text").cast(pa.binary())]
            own = pa.array([xxhash.xxh3_128_digest(s) == i for s, i in zip(sets, batch.column("set_id").to_pylist())], pa.bool_())
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "shingles"]).filter(own)

    return run


def _verify(percent: int):
    """Links of a group's documents on full sets, as a spanning forest."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.drop_duplicates("rep").sort_values("rep")
        rep = df["rep"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in df["shingles"]]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
        order = np.argsort(flat, kind="stable")
        starts = np.searchsorted(flat[order], np.arange(flat.max() + 2 if len(flat) else 1))
        posting = owner[order]
        ends = np.cumsum(sizes)
        label = np.arange(len(rep))
        edges = []
        for i in range(len(rep) - 1):
            if (label == label[i]).all():
                break
            ids = flat[ends[i] - sizes[i]:ends[i]]
            low, high = starts[ids], starts[ids + 1]
            many = high - low
            total = np.concatenate([[0], np.cumsum(many)])
            shared = np.bincount(posting[np.repeat(low - total[:-1], many) + np.arange(total[-1])], minlength=len(rep))
            linked = 100 * shared >= percent * (sizes + sizes[i] - shared)
            linked[:i + 1] = False
            for j in np.flatnonzero(linked):
                if label[i] != label[j]:
                    edges.append((rep[i], rep[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(edges, columns=["u", "v"]).astype("int64")

    return run


def near_dedup(docs: DataFrame, percent: int = 85, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of docs (doc_id, text).

    Documents link when 100 * intersection >= percent * union of their shingle sets.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(rows.mapInArrow(_sign(words), "doc_id long, n_shingles long, set_id binary, sig binary"), "near_signatures")
    classes = signed.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("size"))
    classes = stored(classes, "near_classes")
    keyed = classes.where("rep is not null").select("rep", "n", "sig").mapInArrow(_key_rows, "key long, rep long, n long, sig binary, tie long, stands boolean")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    cells = stored(connected_components(dealt.mapInArrow(_tie(percent), "u long, v long"), "near_cells"), "near_cells")
    sized = cells.join(classes.select("rep", "n", "set_id"), F.col("node") == F.col("rep")).select("rep", F.col("component").alias("cell"), "n", "set_id")
    blocks = sized.groupBy("cell").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = sized.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    texts = members.join(rows, F.col("rep") == F.col("doc_id")).select("rep", "cell", "blocks", "block", "set_id", "text")
    sets = texts.mapInArrow(_shingle(words), "rep long, cell long, blocks int, block int, shingles binary")
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("rep", "shingles", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = met.groupBy("cell", "i", "j").applyInPandas(_verify(percent), "u long, v long")
    found = connected_components(links, "near_components").select(F.col("node").alias("member"), "component")
    labelled = classes.join(found, F.col("rep") == F.col("member"), "left").select("set_id", "size", F.coalesce("component", "rep").alias("component"))
    out = join_hot(signed.drop("sig"), labelled, "set_id", "size")
    component = F.coalesce("component", F.when(F.col("set_id").isNull(), F.col("doc_id")))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
