"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Words and runs of marks are hashed, alone and in pairs, into 2**BITS weights;
their shapes (capitals, marks, a word said again) give further n-grams. A
document's vector holds each n-gram's share of the document, so its score is
a sparse dot product, a bias and a sigmoid. Weights are learnt one document
at a time with follow-the-regularised-leader updates.

Training reads MAX_TRAIN labelled rows at most, those with the smallest hash
of their doc_id (a documented bound; scoring reads every row). Rows whose
crc32(doc_id as text) mod 3 is 1 are held out.

Defined results: null and empty texts have no n-grams and get the bias's
score; without labels every score is 0.5; rows with a null doc_id are never
held out nor learnt from; repeated rows get equal scores; a doc_id with
several labels counts once, with the smallest; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.packing import slices

BITS = 18
SHAPE_BITS = 10
MAX_TRAIN = 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.0005, 0.001
SCALE = 8.0
SLICE_CHARS = 2 << 20
HELD_TOKENS = 400_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
SAID_AGAIN = 15


class Hasher:
    """Feature numbers of texts; weights lie in one array, n-grams of words first, then those of shapes."""

    size = (1 << BITS) + (1 << 3 * 4)

    def __init__(self):
        self.held: dict[str, int] = {}

    def _number(self, token: str) -> int:
        import xxhash

        if token[0].isalnum():
            shape = 1 if token.islower() else 2 if token.istitle() else 3 if token.isupper() else 4 if token.isdigit() else 5
        else:
            shape = 8 + min(2, len(token) - 1) if token[0] in ".,;:?!'\"()-" else 11 + min(2, len(token) - 1)
        return xxhash.xxh64_intdigest(token.lower()) & 0x0FFFFFFFFFFFFFFF | shape << 60

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(features, index of the text of each)."""
        tokens = [TOKEN.findall(t) for t in texts]
        if len(self.held) > HELD_TOKENS:
            self.held = {}
        for w in set().union(*tokens).difference(self.held):
            self.held[w] = self._number(w)
        counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        codes = np.fromiter(map(self.held.__getitem__, chain.from_iterable(tokens)), np.uint64, int(counts.sum()))
        doc = np.repeat(np.arange(len(tokens)), counts)
        shape = (codes >> np.uint64(60)).astype(np.int64)
        pair = doc[1:] == doc[:-1]
        shape[1:][pair & (codes[1:] == codes[:-1])] = SAID_AGAIN
        with np.errstate(over="ignore"):
            one = codes * np.uint64(0x9E3779B97F4A7C15)
            two = (codes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[1:]) * np.uint64(0x165667B19E3779F9)
        triple = pair[1:] & pair[:-1]
        base = 1 << BITS
        features = [
            (one >> np.uint64(64 - BITS)).astype(np.int64), (two >> np.uint64(64 - BITS)).astype(np.int64)[pair],
            base + shape, base + 16 * shape[:-1][pair] + shape[1:][pair] + 16,
            base + (256 * shape[:-2] + 16 * shape[1:-1] + shape[2:])[triple] if len(shape) > 2 else np.zeros(0, np.int64)]
        docs = [doc, doc[1:][pair], doc, doc[1:][pair], doc[2:][triple] if len(doc) > 2 else np.zeros(0, np.int64)]
        return np.concatenate(features), np.concatenate(docs)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last, by FTRL-proximal over the rows in the order given."""
    hasher = Hasher()
    rows = []
    for i, j in slices(texts, SLICE_CHARS):
        f, d = hasher(texts[i:j])
        order = np.argsort(d, kind="stable")
        for part in np.split(f[order], np.cumsum(np.bincount(d, minlength=j - i))[:-1]):
            index, count = np.unique(part, return_counts=True)
            rows.append((np.append(index, hasher.size), np.append(SCALE * count / max(1, len(part)), 1.0)))
    z, n = np.zeros(hasher.size + 1), np.zeros(hasher.size + 1)

    def weights(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for (index, x), y in zip(rows, labels):
            w = weights(index)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA * w
            n[index] += g * g
    return weights(slice(None))


def score(texts: list[str], weights: np.ndarray, hasher: Hasher) -> np.ndarray:
    out = np.zeros(len(texts))
    for i, j in slices(texts, SLICE_CHARS):
        f, d = hasher(texts[i:j])
        out[i:j] = SCALE * np.bincount(d, weights[f], j - i) / np.maximum(1, np.bincount(d, minlength=j - i))
    return 1 / (1 + np.exp(-np.clip(out + weights[-1], -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> np.ndarray:
    """Learn from the labelled rows that aren't held out; one task, max_train rows at most."""
    chosen = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("doc_id is not null and label is not null")
    chosen = chosen.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(max_train)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            df = pd.concat(parts)
            yield pd.DataFrame({"weights": [train(df["text"].tolist(), df["label"].tolist()).tobytes()]})

    dealt = rows.select("text", "label", "place").repartition(1).sortWithinPartitions("place", "text")
    got = dealt.mapInPandas(run, "weights binary").collect()
    return np.frombuffer(got[0]["weights"]) if got else np.zeros(Hasher.size + 1)


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted per row of docs (doc_id, text)."""
    weights = fit(docs, labels, max_train)
    shipped = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = Hasher(), shipped.value
        for b in batches:
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(score(b.column("text").to_pylist(), w, hasher))], names=["doc_id", "held_out", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
