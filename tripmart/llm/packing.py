"""Mixture-controlled packing of documents into token windows.

Each source is a queue of its documents' tokens. Windows are filled by deficit
round-robin: a window's slots of ``quantum`` tokens are dealt to the sources by
their weights, and what a source is owed beyond whole slots is its deficit,
carried to the next window. The deficit after w windows has a closed form, the
rounding of cumulative shares, so every task can tell the window and offset of
any token by itself: deficits carry across windows and partitions without one
task walking through them. When a queue runs dry, its share goes to the others
(a new phase); what is left below whole windows is laid end to end at the end.
All windows but the last are full.

1. Documents are tokenized once and written; each task notes where in its own
   part of a queue every document starts.
2. Sums per (task, source) give each part's place in the queue. Only one row a
   source reaches the driver, for the phases.
3. Tasks cut documents into pieces and place them.

Defined results: null and empty texts are one end token; a null source is a
queue of its own; repeated rows are packed again; empty tables give no pieces;
extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored

LENGTH = 2048
QUANTUM = 64
END_ID = 1
#: Characters of text tokenized at a time, and words remembered by a worker.
SLICE_CHARS = 4 << 20
HELD_WORDS = 1_000_000

# Letters that stay single letters under the tokenizer's normaliser, the characters
# of texts whose words are told apart here, and the tokenizer's own pattern of a word over those.
LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž"
PLAIN = re.compile(f"[{LETTERS}]+")
SAFE = re.compile(f"[\\t-\\r -~{LETTERS}]*")
PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins across spaces, remembering words.

    Runs of letters are encoded many at a time: each ends with the only token
    of its run that is marked as a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """A word is a number; its ids lie at starts[number] in one array."""
        self.held: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, texts one after another, and the number of ids of each text."""
        # texts with other characters are parted at spaces only, and their words left to the tokenizer
        words = [PRETOKEN.findall(t.lower()) if SAFE.fullmatch(t) and "<|" not in t else re.split("[ \n]+", t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(chain.from_iterable(words))
        numbers = self._numbers(flat)
        if (unknown := np.flatnonzero(numbers < 0)).size:
            new = {flat[i] for i in unknown.tolist()}
            if len(self.held) + len(new) > HELD_WORDS:
                self._forget()
                new, unknown = set(flat), np.arange(len(flat))
            self._remember(list(new))
            numbers[unknown] = self._numbers([flat[i] for i in unknown.tolist()])
        sizes = self.sizes[numbers]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[numbers] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers, -1 for words not remembered."""
        return np.fromiter(map(self.held.get, words, repeat(-1)), np.int64, len(words))

    def _remember(self, new: list[str]) -> None:
        """Encode new words; runs of letters many at a time, told apart by their ends."""
        plain = [w for w in new if PLAIN.fullmatch(w)]
        other = [w for w in new if not PLAIN.fullmatch(w)]
        order, ids, sizes = [], [], []
        for i in range(0, len(plain), 5000):
            part = plain[i:i + 5000]
            got = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[got]) + 1
            if len(stops) != len(part):
                other += part
                continue
            order += part
            ids.append(got)
            sizes.append(np.diff(np.concatenate([[0], stops])))
        for i in range(0, len(other), 5000):
            part = other[i:i + 5000]
            each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            order += part
            ids.append(np.fromiter(chain.from_iterable(each), np.uint32))
            sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        if order:
            size = np.concatenate(sizes).astype(np.int64)
            self.held.update(zip(order, range(len(self.held), len(self.held) + len(order))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(size) - size])
            self.sizes = np.concatenate([self.sizes, size])
            self.ids = np.concatenate([self.ids, *ids])


def worker_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker: Spark reuses a worker for many tasks, and words learnt serve all of them."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_word_tokenizers", {})
    if path not in held:
        held[path] = WordTokenizer(path)
    return held[path]


def slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about ``most`` characters together, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(path)
        part = TaskContext.get().partitionId()
        queued: dict[str | None, int] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sources = batch.column("source").to_pylist()
            for i, j in slices(texts, SLICE_CHARS):
                ids, sizes = tokenizer.encode(texts[i:j])
                stops = np.cumsum(sizes)
                ids = np.insert(ids, stops, END_ID)
                sizes = sizes + 1
                starts = []
                for s, n in zip(sources[i:j], sizes.tolist()):
                    starts.append(queued.get(s, 0))
                    queued[s] = starts[-1] + n
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                # 16 bits hold this vocabulary; wider ones take 32
                kind = np.uint16 if len(tokenizer.ends) <= 65536 else np.uint32
                data = ids.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                blobs = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((cuts * width).astype(np.int32).tobytes()), pa.py_buffer(data)])
                yield pa.record_batch(
                    [batch.column("doc_id").slice(i, j - i), batch.column("source").slice(i, j - i), pa.array(sizes), pa.array(np.full(j - i, part, np.int32)), pa.array(starts, pa.int64()), blobs],
                    names=["doc_id", "source", "doc_tokens", "part", "start_in_part", "ids"])

    return run


class Schedule:
    """Windows of the round-robin: which window and offset hold slot c of queue s.

    ``slots``: whole slots of each queue; ``weights``: their shares, by default
    the queues' sizes, so that all run dry together. A phase is (first window,
    windows, slots of each queue used before, cumulative weights).
    """

    def __init__(self, tokens: list[int], length: int, quantum: int, weights: list[int] | None = None):
        self.length, self.quantum, self.per = length, quantum, length // quantum
        slots = [t // quantum for t in tokens]
        weights = list(weights) if weights else list(slots)
        used, window, self.phases = [0] * len(slots), 0, []
        while True:
            active = [w if u < k else 0 for w, u, k in zip(weights, used, slots)]
            total = sum(active)
            if not total:
                break
            # a queue gets at most ceil(share) slots, so it lasts this many windows
            last = min(((k - u) * total) // (w * self.per) for w, u, k in zip(active, used, slots) if w)
            cumulative = [0]
            for w in active:
                cumulative.append(cumulative[-1] + w)
            while last and any(self._dealt(cumulative, i, last) > k - u for i, (u, k) in enumerate(zip(used, slots))):
                last -= 1
            if not last:
                # too little of a queue for one more window: it goes to the end
                least = min((i for i, w in enumerate(active) if w), key=lambda i: (slots[i] - used[i]) * total // (active[i]) if active[i] else 0)
                weights[least] = 0
                continue
            self.phases.append((window, last, tuple(used), tuple(cumulative)))
            used = [u + self._dealt(cumulative, i, last) for i, u in enumerate(used)]
            window += last
        self.used, self.windows = used, window
        left = [t - u * quantum for t, u in zip(tokens, used)]
        self.tails = [sum(left[:i]) for i in range(len(left))]

    def _dealt(self, cumulative: list[int], i: int, windows: int) -> int:
        """Slots of queue i in the first so many windows of a phase: owed shares, rounded together."""
        n, total = windows * self.per, cumulative[-1]
        return n * cumulative[i + 1] // total - n * cumulative[i] // total

    def place(self, queue: int, start: int, length: int) -> list[tuple[int, int, int, int]]:
        """Pieces (start in the queue, length, window, offset) of a stretch of a queue."""
        out, at, stop, q = [], start, start + length, self.quantum
        for first, windows, used, cumulative in self.phases:
            low, total = used[queue], cumulative[-1]
            c0, c1 = cumulative[queue], cumulative[queue + 1]
            if c0 == c1:
                continue
            high = low + self._dealt(cumulative, queue, windows)
            while at < min(stop, high * q):
                c = at // q - low
                # the window whose share holds slot c: an estimate, then a step or two
                w = min(windows - 1, c * total // ((c1 - c0) * self.per))
                while self._dealt(cumulative, queue, w) > c:
                    w -= 1
                while (end := self._dealt(cumulative, queue, w + 1)) <= c:
                    w += 1
                before = self._dealt(cumulative, queue, w)
                # the slots of the queues before this one in window w
                lead = (w + 1) * self.per * c0 // total - w * self.per * c0 // total
                take = min(stop, (low + end) * q) - at
                out.append((at, take, first + w, lead * q + at - (low + before) * q))
                at += take
        base = self.windows * self.length + self.tails[queue] - self.used[queue] * q
        while at < stop:
            where = base + at
            take = min(stop - at, self.length - where % self.length)
            out.append((at, take, where // self.length, where % self.length))
            at += take
        return out


def _cut(schedule: Schedule, numbers: dict[str | None, int], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint16 if width == 2 else np.uint32
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("source").to_pylist(), batch.column("doc_tokens").to_pylist(), batch.column("first").to_pylist(), batch.column("ids"))
            out: list[tuple] = []
            for doc_id, source, n, first, ids in rows:
                wide = np.frombuffer(ids.as_buffer(), kind).astype("<u4").tobytes()
                for at, size, window, offset in schedule.place(numbers[source], first, n):
                    start = at - first
                    out.append((doc_id, start, size, zlib.crc32(wide[4 * start:4 * (start + size)]), n, window, offset))
            cols = list(zip(*out)) or [[]] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, quantum: int = QUANTUM, weights: dict[str | None, int] | None = None) -> DataFrame:
    """Pieces of docs (doc_id, text, source) in windows of ``length`` tokens.

    ``weights``: target shares by source, as integers; sources without one go to
    the end. By default every window has the whole table's proportions.
    """
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), source.alias("source"))
    kinds = "doc_id long, source string, doc_tokens long, part int, start_in_part long, ids binary"
    tokens = stored(rows.mapInArrow(_tokenize(tokenizer_path), kinds), "packing_tokens")
    parts = tokens.groupBy("source", "part").agg(F.sum("doc_tokens").alias("n"))
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # written, so that Spark knows its size when it picks the join
    parts = stored(parts.select(F.col("source").alias("s"), F.col("part").alias("p"), "n", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before")), "packing_parts")
    totals = parts.groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.col("s").asc_nulls_first()).collect()
    schedule = Schedule([r["n"] for r in totals], length, quantum, [int(weights.get(r["s"], 0)) for r in totals] if weights else None)
    numbers = {r["s"]: i for i, r in enumerate(totals)}
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab().values()) < 65536 else 4
    placed = tokens.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    placed = placed.select("doc_id", "source", "doc_tokens", (F.col("before") + F.col("start_in_part")).alias("first"), "ids")
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(_cut(schedule, numbers, width), names)
