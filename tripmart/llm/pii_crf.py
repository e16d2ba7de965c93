"""Personal data by patterns and a linear-chain conditional random field.

Patterns find the base spans: e-mail and IP addresses, card and phone numbers.
The random field adds spans that no pattern fits, such as numbers written
without a country code or addresses with the sign spelt out. It is trained
on the small labelled table below, over word-shape features, by the gradient
of the conditional likelihood (forward-backward), and decodes by Viterbi over
many stretches of words at a time.

A label other than "outside" is allowed only within REACH words of a word
that holds a digit or an at sign, in any spelling. So all other stretches are
outside without decoding, and this loses nothing. Spans that touch a base
span, or whose kind's digit rules fail, are not added.

Defined results: null and empty texts have no spans; every row is searched
whole; repeated rows get equal spans; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
REACH = 4
EPOCHS = 120
RATE, DECAY = 0.3, 0.002
#: Word places decoded together, over all stretches of a group.
PLACES = 200_000
#: Digits and repeated signs of a word count up to this many: more make no other feature.
MOST_RUN = 20
LONG_RUN = re.compile(r"(.)\1{20,}", re.S)

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts within a run of digits: what fails at the run's start fails there too
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CUE = re.compile(r"[0-9@]|[\[({<]\s?(?:at|AT|At)\s?[\])}>]")
#: A word that a bracketed at joins from two parts.
JOINED = re.compile(r"\w[\[({<](?:at|AT|At)[\])}>]\w")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# The labelled table. A span is [kind: text].
LABELLED = [
    "please call [phone: 555-0134] after lunch", "my number is [phone: (415) 555-0172] at home", "phone [phone: 0171 555 0123] or write",
    "reach us under [phone: 030 5550 1234] any day", "tel [phone: 555.013.4477] ext 12", "fax : [phone: 212-555-0198] today",
    "telephone [phone: (020) 7946 0018] for help", "call [phone: 1-800-555-0199] now", "ring [phone: 06 12 34 56 78] tonight",
    "mobile [phone: 0049 151 5550 123] or office", "dial [phone: 91 555 01 23] in madrid", "cell [phone: 650-555-0111] please",
    "mail me at [email: jane (at) example.org] soon", "write to [email: john [at] mail.example.com] now", "email [email: info (at) example (dot) net] please",
    "contact [email: sales [at] example [dot] com] today", "send it to [email: max@localhost] again", "address [email: ann.lee(at)example.org] is new",
    "ask [email: tom(at)example.com] for it", "or [email: kim[at]mail.example.net] first", "and [email: pat.lee.ray{at}example.org] too", "mail [email: jo_li(at)example.co.uk] again",
    "see [email: bo.ek(at)example.net] there", "find us at [email: desk(at)example.org] daily", "by [email: ann[at]example.net] or post", "the author [email: r.m.stone(at)mail.example.com] wrote it",
    "host [ip: 10,0,0,12] is down", "server [ip: 192-168-1-20] answered", "the address [ip: 172 . 16 . 4 . 9] was used",
    "card [card: 4111.1111.1111.1111] expires soon", "visa [card: 4111/1111/1111/1111] was billed", "pay with [card: 5500_0000_0000_0004] please",
    "in 1998 there were 45 cases and 12 deaths", "chapter 3 page 117 of the book", "it cost 12.50 or 1,200 in all", "born on 12 may 1975 in rome",
    "version 2.4.1 of 2019-04-03 fixes 17 bugs", "the 3rd of 10 rooms has 24 seats", "see section 4.2.1 and table 7", "about 3,000,000 people in 2011",
    "order 554321 was sent on 2020-01-15", "token = \"9f86d081884c7d659a2feaa0c55ad015\" is old", "key 24be64439e3e49cf46b2d7c90f3602a3 was lost",
    "the ratio was 16:9 in 100 of 250 tests", "from 9 to 17 h on 5 days", "isbn 978 was given to 40 books", "10 20 30 40 50 60 is a list", "he ran 100 m in 12.3 s",
    "we meet at 10 at the gate", "at the end @ all of it", "rated 4/5 by 1200 users", "license MIT 2.0 copyright 2015 2021",
]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind, then place; linear in the text."""
    out: list[tuple[int, int, int]] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGIT.findall(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def shape(word: str) -> str:
    """The whole word with letters as x and digits as d: runs of letters, and of letters joined by stops, are folded."""
    x = re.sub(r"[0-9]", "d", re.sub(r"[^\W\d_]+", "x", word))
    return LONG_RUN.sub(lambda m: m.group()[:MOST_RUN], re.sub(r"x(?:[._+%-]x)+", "x.x", x))


def features(words: list[str]) -> list[list[str]]:
    """Names of what is seen at each word: its shape, digits and sign, and its neighbours'."""
    shapes = [shape(w) for w in words]
    digits = [min(MOST_RUN, len(DIGIT.findall(w))) for w in words]
    low = [w.lower().strip(":.,;") if w.isascii() and len(w) < 12 and not DIGIT.search(w) else "" for w in words]
    out = []
    for i, w in enumerate(words):
        f = ["bias", f"s={shapes[i]}", f"d={digits[i]}", f"cue={bool(CUE.search(w))}", f"joined={bool(JOINED.search(w))}", f"w={low[i]}", f"first={w[0]}" if not w[0].isalnum() else "first=x"]
        for d in (-1, 1):
            j = i + d
            f += [f"s{d}={shapes[j]}", f"w{d}={low[j]}", f"d{d}={digits[j]}"] if 0 <= j < len(words) else [f"edge{d}"]
        if 0 < i < len(words) - 1:
            f.append(f"ss={shapes[i - 1]}|{shapes[i + 1]}")
        out.append(f)
    return out


LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: An inside label follows only its own kind.
ALLOWED = np.array([[b[0] != "I" or a[2:] == b[2:] and a != "O" for b in LABELS] for a in LABELS])
START = np.array([b[0] != "I" for b in LABELS])


def labelled_rows() -> list[tuple[list[str], list[int]]]:
    rows = []
    for line in LABELLED:
        words, labels = [], []
        for kind, inside, outside in re.findall(r"\[(email|ip|card|phone): ((?:[^\[\]]|\[\w+\])*)\]|([^\s\[]+)", line):
            for i, w in enumerate((inside or outside).split()):
                words.append(w)
                labels.append(LABELS.index(f"{'B' if i == 0 else 'I'}-{kind}") if kind else 0)
        rows.append((words, labels))
    return rows


class ChainField:
    """Weights of features by label, and of label pairs."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    @classmethod
    def train(cls, rows: list[tuple[list[str], list[int]]], epochs: int = EPOCHS) -> "ChainField":
        seen = [features(w) for w, _ in rows]
        names: dict[str, int] = {}
        index = [[[names.setdefault(x, len(names)) for x in f] for f in fs] for fs in seen]
        k = len(LABELS)
        emit, move = np.zeros((len(names), k)), np.zeros((k, k))
        sums = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
        closed = np.where(ALLOWED, 0.0, -1e9)
        for _ in range(epochs):
            ge, gm = -DECAY * emit, -DECAY * move
            for (words, labels), fs in zip(rows, index):
                e = np.stack([emit[f].sum(axis=0) for f in fs])
                e[0, ~START] = -1e9
                t, n = move + closed, len(fs)
                a, b = np.zeros((n, k)), np.zeros((n, k))
                a[0] = e[0]
                for i in range(1, n):
                    a[i] = e[i] + np.logaddexp.reduce(a[i - 1][:, None] + t, axis=0)
                for i in range(n - 2, -1, -1):
                    b[i] = np.logaddexp.reduce(t + (e[i + 1] + b[i + 1])[None, :], axis=1)
                z = np.logaddexp.reduce(a[-1])
                p = np.exp(a + b - z)
                for i, f in enumerate(fs):
                    g = -p[i]
                    g[labels[i]] += 1
                    ge[f] += g
                    if i:
                        gm -= np.exp(a[i - 1][:, None] + t + (e[i] + b[i])[None, :] - z)
                        gm[labels[i - 1], labels[i]] += 1
            for w, g, s in ((emit, ge, sums[0]), (move, gm, sums[1])):
                s += g * g
                w += RATE * g / np.sqrt(s)
        return cls(names, emit, move)

    def decode(self, stretches: list[list[str]]) -> list[list[int]]:
        """Best labels of each stretch of words: Viterbi over groups of stretches, by word place.

        A group's stretches times its longest one are PLACES at most, or it is one stretch. Scores are made
        for PLACES places at a time; of a longer stretch only a byte a place and label is held, so the path is exact.
        """
        out: list[list[int]] = [[] for _ in stretches]
        order = sorted((i for i, s in enumerate(stretches) if s), key=lambda i: len(stretches[i]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(stretches[order[stop]]) <= PLACES:
                stop += 1
            for i, path in zip(order[at:stop], self._paths([stretches[i] for i in order[at:stop]])):
                out[i] = path
            at = stop
        return out

    def _scores(self, words: list[str], start: int, stop: int) -> np.ndarray:
        """Label scores of the words from ``start`` to ``stop``, which see one neighbour beyond."""
        low = max(0, start - 1)
        seen = features(words[low:stop + 1])[start - low:stop - low]
        return np.stack([self.emit[[self.names[x] for x in f if x in self.names]].sum(axis=0) for f in seen])

    def _paths(self, group: list[list[str]]) -> list[list[int]]:
        """Viterbi over a group's stretches; shorter ones first."""
        k, size = len(LABELS), np.array([len(s) for s in group])
        n, step = int(size[-1]), max(1, PLACES // len(group))
        t = np.where(ALLOWED, self.move, -1e9)
        best, back = np.zeros((len(group), k)), np.zeros((len(group), n, k), np.int8)
        for c in range(0, n, step):
            stop = min(n, c + step)
            e = np.zeros((len(group), stop - c, k))
            for r, words in enumerate(group):
                if len(words) > c:
                    e[r, :min(len(words), stop) - c] = self._scores(words, c, min(len(words), stop))
            for j in range(c, stop):
                if j == 0:
                    best = np.where(START, e[:, 0], -1e9)
                    continue
                moves = best[:, :, None] + t[None]
                back[:, j] = moves.argmax(axis=1)
                best = np.where((j < size)[:, None], moves.max(axis=1) + e[:, j - c], best)
        paths = []
        for r, last in enumerate(best.argmax(axis=1).tolist()):
            path = [last]
            for j in range(size[r] - 1, 0, -1):
                path.append(int(back[r, j, path[-1]]))
            paths.append(path[::-1])
        return paths


def stretches_of(text: str) -> list[list[tuple[int, int]]]:
    """Places of the words within REACH of a word with a cue, in runs."""
    if not CUE.search(text):
        return []
    out: list[list[tuple[int, int]]] = []
    stop = 0
    for m in CUE.finditer(text):
        if m.start() < stop:
            continue  # in a run already
        # the cue's own word and REACH words on both sides; further cues lengthen the run
        start = m.start()
        for _ in range(REACH + 1):
            while start > stop and text[start - 1] not in " \t\n\x0b\x0c\r":
                start -= 1
            if _ < REACH:
                while start > stop and text[start - 1] in " \t\n\x0b\x0c\r":
                    start -= 1
        run, left = [], REACH
        for w in WORD.finditer(text, start):
            if w.end() <= m.start():
                run.append(w.span())
                continue
            if CUE.search(w.group()):
                left = REACH
            elif left == 0:
                break
            else:
                left -= 1
            run.append(w.span())
        out.append(run)
        stop = run[-1][1] if run else m.end()
    return out


def _valid(kind: str, found: str) -> bool:
    digits = "".join(DIGIT.findall(found))
    if kind == "email":
        return bool(re.search(r"@|[\[({<]\s?(?:at|AT|At)\s?[\])}>]", found)) and len(found) >= 6
    if kind == "ip":
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return 7 <= len(digits) <= 15 and not re.search(r"[^\W\d_]", found)


def find(texts: list[str], field: ChainField) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    runs = [(i, run) for i, t in enumerate(texts) for run in stretches_of(t)]
    labels = field.decode([[texts[i][a:b] for a, b in run] for i, run in runs])
    added: list[list] = [[] for _ in texts]
    for (i, run), path in zip(runs, labels):
        j = 0
        while j < len(path):
            if path[j] == 0:
                j += 1
                continue
            k = j + 1
            while k < len(path) and LABELS[path[k]][0] == "I":
                k += 1
            kind = (path[j] - 1) // 2
            start, end = run[j][0], run[k - 1][1]
            while end > start and texts[i][end - 1] in ".,;:!?%&$#*|\"'":
                end -= 1
            if _valid(KINDS[kind], texts[i][start:end]) and not any(s < end and start < e for _, s, e in base[i]):
                added[i].append((kind, start, end))
            j = k
    return list(zip(base, added))


def find_personal_data(docs: DataFrame, field: ChainField | None = None) -> DataFrame:
    """doc_id, base and added spans (arrays of kind, start, end; code points) per row of docs (doc_id, text)."""
    field = field or ChainField.train(labelled_rows())
    span = "array<struct<kind:string,start:int,end:int>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = find(b.column("text").to_pylist(), field)
            columns = [pa.array([[(KINDS[k], s, e) for k, s, e in sorted(row[i])] for row in found], arrow) for i in (0, 1)]
            yield pa.record_batch([b.column("doc_id"), *columns], names=["doc_id", "base", "added"])

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, base {span}, added {span}")


def redact(docs: DataFrame, field: ChainField | None = None) -> DataFrame:
    """docs with each span's text replaced by its kind in brackets; all columns stay."""
    field = field or ChainField.train(labelled_rows())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            found = find([t or "" for t in texts], field)
            out = [t and _replaced(t, base + added) for t, (base, added) in zip(texts, found)]
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Spans that overlap are one; it takes the kind of the first."""
    whole: list[list[int]] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if whole and s < whole[-1][2]:
            whole[-1][2] = max(whole[-1][2], e)
        else:
            whole.append([kind, s, e])
    for kind, s, e in reversed(whole):
        text = f"{text[:s]}[{KINDS[kind]}]{text[e:]}"
    return text
