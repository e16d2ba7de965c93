"""SentencePiece encoding with seeded merge-dropout, and decoding.

Merge-type models join the best-scored pair of neighbouring pieces until none
is left. With dropout, a candidate merge is skipped when a keyed hash of seed,
document, the word's place and the candidate's place in it falls below the
rate; a skipped candidate stays skipped. Each occurrence of a word has skips of
its own. So the same seed gives the same pieces on any
cluster, other seeds give others, and each decodes to the same text.

The agenda is processed for many words at a time: each round takes every
word's best candidate that is left (highest score, leftmost), so every word
sees the merges of its own agenda in order. A word beyond LONG_WORD characters has a heap for its
agenda instead, with the same merges. Words never join across spaces.
A word's merges without dropout are kept, with their places: an occurrence
that skips none of them has just these pieces, all others are merged anew.
Characters outside the vocabulary become byte pieces, and so does SentencePiece's
own mark for a space, so that it isn't decoded as one.

Defined results: null and empty texts have no pieces; white space is kept;
very long words and texts are encoded whole; of candidates with equal scores the leftmost comes
first; an empty table gives no rows; repeated rows with equal doc_id get equal
pieces; a null doc_id counts as key 0; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.packing import slices

RATE = 0.1
SEED = 1
SLICE_CHARS = 2 << 20
HELD_WORDS = 400_000
SLOT_BITS = 20
SPACE = "▁"
UNIT = re.compile(" +[^ ]*")
U = np.uint64
MASK = 2**64 - 1
#: Words of more characters have an agenda of their own: rounds over all of a word's symbols would take quadratic time.
LONG_WORD = 256


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _mixed(x: int) -> int:
    """``_mix`` of one number."""
    x &= MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def _place(i: int, j: int, stop: int) -> int:
    """A candidate is known by where its two parts and its end lie in the word."""
    return i * 0x9E3779B97F4A7C15 + j * 0xC2B2AE3D27D4EB4F + stop * 0x165667B19E3779F9


class PieceEncoder:
    def __init__(self, path: str, seed: int = SEED, rate: float = RATE):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.number = {self.pieces[i]: i for i in normal}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # the bytes that each piece stands for, one piece after another
        byte_of = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        spelt = [byte_of[i] if i in byte_of else b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.spelt, self.spelt_sizes = np.frombuffer(b"".join(spelt), np.uint8), np.fromiter(map(len, spelt), np.int64, n)
        self.spelt_starts = np.cumsum(self.spelt_sizes) - self.spelt_sizes
        self.seed, self.rate, self.n = seed, rate, n
        # every way to make a piece of two pieces: (left, right) -> made; the last entry stands for no pair
        made = sorted((self.number[p[:k]] * n + self.number[p[k:]], i) for p, i in self.number.items() for k in range(1, len(p)) if p[:k] in self.number and p[k:] in self.number)
        self.pairs = np.array([x[0] for x in made] + [1 << 62], np.int64)
        self.made = np.array([x[1] for x in made] + [0], np.int32)
        score = np.array([sp.get_score(i) for i in range(n)])
        # places in the order of scores, the highest first; pieces of one score share a place
        self.rank = np.append(np.unique(-score[self.made[:-1]], return_inverse=True)[1], n).astype(np.int64)
        # a space is SentencePiece's mark; the mark itself, where a text has it, is spelt in bytes
        self.letter = np.full(0x110000, -1, np.int32)
        for p, i in self.number.items():
            if len(p) == 1:
                self.letter[ord(" " if p == SPACE else p)] = i
        # pairs by hash, the next slot where one is taken
        self.slots, self.probes = np.full(1 << SLOT_BITS, len(made), np.int32), 0
        left = np.arange(len(made))
        while len(left):
            at = self._slot(self.pairs[left]) + self.probes & (1 << SLOT_BITS) - 1
            free = self.slots[at] == len(made)
            self.slots[at[free]] = left[free]
            left = left[self.slots[at] != left]
            self.probes += 1
        self.by_code: dict[int, int] | None = None
        self._forget()

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (codes.view(np.uint64) * U(0x9E3779B97F4A7C15) >> U(64 - SLOT_BITS)).astype(np.int64)

    def _pair(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of pairs by their codes; the last one stands for no pair."""
        slot = self._slot(codes)
        out = self.slots[slot]
        left = np.flatnonzero(self.pairs[out] != codes)
        for probe in range(1, self.probes + 1):
            # an empty slot ends the search
            left = left[out[left] != len(self.pairs) - 1]
            if not len(left):
                return out
            out[left] = self.slots[slot[left] + probe & (1 << SLOT_BITS) - 1] if probe < self.probes else len(self.pairs) - 1
            left = left[self.pairs[out[left]] != codes[left]]
        return out

    def _forget(self) -> None:
        """A word is a number; it has its pieces and its merges (their places, mixed) without dropout."""
        self.held: dict[str, int] = {}
        self.words: list[str] = []
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.first, self.merges, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def _limit(self) -> np.uint64:
        return U(min(2**64 - 1, int(self.rate * 2**64)))

    def merge(self, words: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of the words under their keys (None: without dropout), one word after another, and each word's number of
        pieces; without dropout also the places of the merges, and each word's number of them."""
        long = np.array([i for i, w in enumerate(words) if len(w) > LONG_WORD], np.int64)
        if not len(long):
            return self._merge_rounds(words, keys)
        short = np.delete(np.arange(len(words)), long)
        ids, sizes, places, merges = self._merge_rounds([words[i] for i in short.tolist()], None if keys is None else keys[short])
        one = [self._merge_agenda(words[i], None if keys is None else int(keys[i])) for i in long.tolist()]
        before = long - np.arange(len(long))  # short words that stand before each long one
        out = []
        for flat, each, many in ((ids, [x[0] for x in one], sizes), (places, [x[1] for x in one], merges)):
            lengths = np.fromiter(map(len, each), np.int64, len(each))
            at = np.concatenate([[0], np.cumsum(many)])[before].astype(np.int64)
            out += [np.insert(flat, np.repeat(at, lengths), np.concatenate(each).astype(flat.dtype)), np.insert(many, before, lengths)]
        return tuple(out)

    def _merge_agenda(self, word: str, key: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and merges' places of one long word, by an agenda and linked neighbours: the same merges in the same order."""
        if self.by_code is None:
            self.by_code = dict(zip(self.pairs[:-1].tolist(), range(len(self.pairs) - 1)))
            self.plain_rank, self.plain_made = self.rank.tolist(), self.made.tolist()
        chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4")
        n, limit, sym = len(chars), int(self._limit()), self.letter[chars].tolist()
        after, before, there = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        agenda: list[tuple[int, int, int, int, int]] = []
        places: list[int] = []

        def propose(i: int) -> None:
            """The candidate of the symbol at i and the next one, unless it is skipped."""
            j = after[i]
            if j >= n or sym[i] < 0 or sym[j] < 0:
                return
            k = self.by_code.get(sym[i] * self.n + sym[j])
            if k is not None and (key is None or _mixed(_mixed(key + _place(i, j, after[j]))) >= limit):
                heapq.heappush(agenda, (self.plain_rank[k], i, j, after[j], k))

        for i in range(n - 1):
            propose(i)
        while agenda:
            _, i, j, stop, k = heapq.heappop(agenda)
            if not (there[i] and there[j] and after[i] == j and after[j] == stop):
                continue  # one of its parts has been merged with another
            places.append(_place(i, j, stop) & MASK)
            sym[i], there[j], after[i] = self.plain_made[k], False, stop
            if stop < n:
                before[stop] = i
            if before[i] >= 0:
                propose(before[i])
            propose(i)
        pieces = [[sym[i]] if sym[i] >= 0 else [self.bytes[b] for b in chr(chars[i]).encode("utf-8", "surrogatepass")] for i in range(n) if there[i]]
        return np.fromiter(chain.from_iterable(pieces), np.int32), np.array(places, np.uint64)

    def _merge_rounds(self, words: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``merge`` for many words at a time, one merge of each word a round."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sym = self.letter[chars]
        odd = sym < 0
        strange, which = np.unique(chars[odd], return_inverse=True)
        sym[odd] = self.n + which
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        at = (np.arange(len(sym)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)  # where a symbol starts in its word
        none, limit = len(self.pairs) - 1, self._limit()

        def place(i: np.ndarray) -> np.ndarray:
            """A candidate is known by where its two parts and its end lie in the word."""
            after = np.minimum(i + 2, len(word) - 1)
            inside = (i + 2 < len(word)) & (word[after] == word[i])
            stop = np.where(inside, at[after], lengths[word[i]])
            with np.errstate(over="ignore"):
                return at[i].astype(np.uint64) * U(0x9E3779B97F4A7C15) + at[i + 1].astype(np.uint64) * U(0xC2B2AE3D27D4EB4F) + stop.astype(np.uint64) * U(0x165667B19E3779F9)

        def candidates(j: np.ndarray) -> np.ndarray:
            """The pair that the symbols at j make with the next one of their word; ``none`` if there is none or it is skipped."""
            out = np.full(len(j), none, np.int32)
            here = np.flatnonzero(word[j] == word[np.minimum(j + 1, len(word) - 1)])
            here = here[j[here] + 1 < len(word)]
            i = j[here]
            known = (sym[i] < self.n) & (sym[i + 1] < self.n)
            here, i = here[known], i[known]
            code = sym[i].astype(np.int64) * self.n + sym[i + 1]
            k = self._pair(code)
            ok = k < none
            here, i, k = here[ok], i[ok], k[ok]
            if keys is not None and len(i):
                with np.errstate(over="ignore"):
                    stays = _mix(_mix(keys[word[i]] + place(i))) >= limit
                here, k = here[stays], k[stays]
            out[here] = k
            return out

        done_sym, done_word, done_at, merged, merges = [], [], [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        best = candidates(np.arange(len(sym)))
        while len(sym):
            # each word's best candidate, the leftmost of equals
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            n = len(sym)
            low = np.minimum.reduceat(self.rank[best] * n + np.arange(n), starts)
            active = low < self.n * n
            i = low[active] % n
            if keys is None:
                merged.append(place(i))
                merges.append(word[i])
            sym[i] = self.made[best[i]]
            keep = np.repeat(active, np.diff(np.append(starts, n)))
            idle = ~keep
            done_sym.append(sym[idle]), done_word.append(word[idle]), done_at.append(at[idle])
            keep[i + 1] = False
            changed = np.cumsum(keep)[i] - 1
            sym, word, at, best = sym[keep], word[keep], at[keep], best[keep]
            # only a new piece and the one before it have other candidates now
            before = changed[changed > 0] - 1
            for j in (changed, before[word[before] == word[before + 1]]):
                best[j] = candidates(j)
        sym, word, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_word, done_at))
        order = np.lexsort((at, word))
        sym, word = sym[order], word[order]
        if len(strange):  # characters outside the vocabulary: their bytes
            spelled = [[self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in strange.tolist()]
            size = np.ones(len(sym), np.int64)
            odd = sym >= self.n
            size[odd] = np.array([len(x) for x in spelled])[sym[odd] - self.n]
            out = np.repeat(sym, size)
            out[np.repeat(odd, size)] = np.fromiter(chain.from_iterable(spelled[s - self.n] for s in sym[odd].tolist()), np.int64)
            sym, word = out, np.repeat(word, size)
        merges = np.concatenate(merges)
        merged = np.concatenate(merged)[np.argsort(merges, kind="stable")]
        return sym.astype(np.int32), np.bincount(word, minlength=len(words)), merged, np.bincount(merges, minlength=len(words))

    def _skips(self, flat: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The occurrences (word numbers and keys) that skip one or more of their word's merges."""
        many = self.merges[flat]
        ends = np.cumsum(many)
        owner = np.repeat(np.arange(len(flat)), many)
        with np.errstate(over="ignore"):
            h = keys[owner] + self.places[np.repeat(self.first[flat] - ends + many, many) + np.arange(len(owner))]
        return np.unique(owner[_mix(_mix(h)) < self._limit()])

    def encode(self, texts: list[str], doc_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, texts one after another, and the number of ids of each text."""
        import xxhash

        words = [UNIT.findall(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        total = int(counts.sum())
        if total == 0:
            return np.zeros(0, np.int32), counts
        place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        new = set().union(*words).difference(self.held)
        if len(self.held) + len(new) > HELD_WORDS:
            self._forget()
            new = set().union(*words)
        order = list(new)
        if order:
            self.held.update(zip(order, range(len(self.words), len(self.words) + len(order))))
            self.words += order
            ids, sizes, places, merges = self.merge(order, None)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.first = np.concatenate([self.first, len(self.places) + np.cumsum(merges) - merges])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
            self.merges, self.places = np.concatenate([self.merges, merges]), np.concatenate([self.places, places])
        flat = np.fromiter(map(self.held.__getitem__, chain.from_iterable(words)), np.int64, total)
        starts, sizes, ids = self.starts[flat], self.sizes[flat], self.ids
        if self.rate:
            with np.errstate(over="ignore"):
                keys = _mix(np.repeat(doc_keys.astype(np.uint64), counts) * U(0x9E3779B97F4A7C15) + place.astype(np.uint64) + U(self.seed) * U(0xC2B2AE3D27D4EB4F))
            skips = self._skips(flat, keys)
            if len(skips):
                new_ids, new_sizes, _, _ = self.merge([self.words[i] for i in flat[skips].tolist()], keys[skips])
                starts[skips], sizes[skips] = len(ids) + np.cumsum(new_sizes) - new_sizes, new_sizes
                ids = np.concatenate([ids, new_ids])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of the pieces, ``sizes`` of them each; the space put before the first word is taken off."""
        n = self.spelt_sizes[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        data = self.spelt[np.repeat(self.spelt_starts[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [data[i:j].decode("utf-8", "replace")[1:] for i, j in zip(cuts[:-1], cuts[1:])]


def encode_documents(docs: DataFrame, model_path: str, seed: int = SEED, rate: float = RATE) -> DataFrame:
    """doc_id, n_pieces, ids (array of int), lossless per row of docs (doc_id, text).

    ``lossless``: the ids, decoded, give the text again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model_path, seed, rate)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("key").to_numpy().view(np.uint64)
            for i, j in slices(texts, SLICE_CHARS):
                ids, sizes = encoder.encode(texts[i:j], keys[i:j])
                same = [a == b for a, b in zip(encoder.decode(ids, sizes), texts[i:j])]
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.record_batch([batch.column("doc_id").slice(i, j - i), pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids", "lossless"])

    key = F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("key")
    rows = docs.select("doc_id", key, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_pieces long, ids array<int>, lossless boolean")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of encoded rows (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model_path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = encoder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
