"""Language-model scores from an Elias-Fano n-gram trie.

The trie has a level per order, in segments of sorted n-grams that workers map
into memory. Level 1 holds the words (by 64-bit hash) and their counts. An
entry of a higher level is a successor of a context, which is the position of
an entry one level below (a word at level 2):

* pointers from contexts to their successors are a monotone sequence, stored
  with Elias-Fano (packed low bits, unary high bits);
* a successor is stored relative to its context: at level 3 not as a word but
  as its rank among the successors of the context's last word, and is found by
  binary search in the context's range;
* the discounted probability (c - D) / c(context) and the context's weight for
  the lower order are 8-bit codes into a segment's table.

Probabilities interpolate absolute discounting down to the add-one unigram, so
they sum to one over the words seen and one unknown (up to the 8-bit codes).
All n-grams are stored (``learn(least=...)`` leaves rare ones of level 2 and up
to the lower order). There is a begin context, and an end token that is counted.

Counting is one shuffle per order: tasks send their distinct n-grams, compressed
and dealt by ranges of (context, successor) - so a frequent context spans
segments - and every range is summed and written as a segment into the shared
folder, atomically. The ranges are quantiles of ``RANGE_KEYS`` tokens a range,
drawn among all training tokens, so a range holds about ``SEGMENT_ROWS`` tokens
and no more distinct n-grams than that, besides the copies of a frequent one,
which its tasks have summed already. The
model grows with the corpus; each worker maps it and reads what it needs. Texts
are turned into word ids once, in a table in the shared folder. What a run of
texts asks for is looked up in order, each n-gram once, so a segment is touched
once a run, and for what it holds of that run alone. The
shared folder must be reachable as a file path (a mounted file system).

Cases: a null text is empty and scores its end token; null ids are learned
from; repeated rows count as often as they occur; without training rows the
model is the unigram over one unknown word; empty tables give no rows. Only id
and text are read.
"""

from __future__ import annotations

import math
import os
import shutil
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, fold, scratch, ship, table, utf8, written
from ledgerline.session import delete_folder

ORDER = 3
DISCOUNT = 0.75
LEAST_COUNT = 1
FOLDS, HELD_OUT = 7, 2
END = b" "  # no word holds a space
SEGMENT_ROWS = 2_000_000
RANGE_KEYS = 128
SLICE_TOKENS = 1_000_000
SLICE_BYTES = 2 << 20
RUN_GRAMS = 2_000_000
REMEMBERED = 1_000_000
READ_THROUGH = 128
_SELECT = np.array([[next((i for i in range(8) if b >> i & 1 and bin(b & ((1 << i) - 1)).count("1") == r), 0)
                     for r in range(8)] for b in range(256)], np.uint8)
_U = np.arange(256, dtype=np.uint64)
_BITS = np.array([0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x0101010101010101, 0x8080808080808080], np.uint64)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


class EliasFano:
    """A monotone sequence of non-negative integers: packed low bits, unary high bits, ranks for select."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ranks: np.ndarray, bits: int):
        self.low, self.high, self.ranks, self.bits = low, high, ranks, bits
        self._words = np.ndarray((max(1, len(low) - 7),), "<u8", low, strides=(1,))

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, int(math.log2(max(1, top / max(1, n)))))
        if bits:
            cells = (values[:, None] >> np.arange(bits)[None, :] & 1).astype(np.uint8)
            low = np.concatenate([np.packbits(cells.ravel(), bitorder="little"), np.zeros(8, np.uint8)])
        else:
            low = np.zeros(8, np.uint8)
        ones = (values >> bits) + np.arange(n)
        unary = np.zeros(-(-(int(ones[-1]) + 1 if n else 1) // 64) * 64, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(high.view("<u8")).astype(np.int64))])
        return cls(low, high, ranks, bits)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ranks, i, side="right") - 1
        left, ones = (i - self.ranks[word]).astype(np.uint64), self.high.view("<u8")[word]
        sums = ones - (ones >> _U[1] & _BITS[0])
        sums = (sums & _BITS[1]) + (sums >> _U[2] & _BITS[1])
        sums = (sums + (sums >> _U[4]) & _BITS[2]) * _BITS[3]       # byte k: the ones up to byte k
        byte = np.bitwise_count(((left * _BITS[3] | _BITS[4]) - sums) & _BITS[4]).astype(np.uint64) << _U[3]
        left -= (sums << _U[8]) >> byte & _U[255]
        place = word * 64 + (byte.view(np.int64) + _SELECT[(ones >> byte & _U[255]).view(np.int64), left.view(np.int64)])
        result = (place - i) << self.bits
        if self.bits:
            bit = i * self.bits
            chunk = self._words[bit >> 3] >> (bit & 7).astype(np.uint64)
            result |= (chunk & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return result


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit codes and their table: means of up to 256 equal shares of the sorted values."""
    distinct = np.unique(values)
    if len(distinct) <= 256:
        return np.searchsorted(distinct, values).astype(np.uint8), distinct.astype(np.float64)
    edges = np.unique(np.quantile(values, np.linspace(0, 1, 257)[1:-1]))
    codes = np.searchsorted(edges, values, side="right")
    total, count = np.bincount(codes, values, len(edges) + 1), np.bincount(codes, minlength=len(edges) + 1)
    return codes.astype(np.uint8), total / np.maximum(count, 1)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array of a segment; a repeated task replaces it with the same bytes."""
    target = os.path.join(folder, f"{name}.npy")
    part = f"{target}.{os.getpid()}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, target)


def _load(folder: str, name: str) -> np.ndarray:
    return np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r").view(np.ndarray)


@dataclass
class Segment:
    """What the driver knows of a segment (one row per written partition)."""

    number: int
    rows: int
    first: int
    first_rel: int
    last: int
    rows_first: int
    rows_last: int
    kept_first: float
    kept_last: float


@dataclass
class Model:
    """The folder and the segments of every level; small, it travels with the tasks."""

    folder: str
    tokens: int
    words: int
    documents: int
    levels: list[list[Segment]]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "reader"}

    @property
    def width(self) -> str:
        """The array type of word ids."""
        return "i" if self.words < (1 << 31) - 1 else "q"


class Words:
    """Level 1."""

    def __init__(self, model: Model):
        self.segments = model.levels[0]
        self.firsts = np.array([s.first for s in self.segments], np.int64)
        self.starts = np.cumsum([0, *[s.rows for s in self.segments]])
        self.hashes = [_load(model.folder, f"1-{s.number}-hash") for s in self.segments]
        self.counts = [_load(model.folder, f"1-{s.number}-count") for s in self.segments]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids, -1 for unknown words."""
        key, back = np.unique(hashes, return_inverse=True)  # once each, neighbours in turn
        ids = np.full(len(key), -1, np.int64)
        cuts = [*np.searchsorted(key, self.firsts).tolist(), len(key)]
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                at = np.searchsorted(self.hashes[s], key[a:b])
                hit = at < len(self.hashes[s])
                hit[hit] = self.hashes[s][at[hit]] == key[a:b][hit]
                ids[a:b][hit] = self.starts[s] + at[hit]
        return ids[back]

    def count(self, ids: np.ndarray) -> np.ndarray:
        if len(self.segments) == 1:
            return np.where(ids < 0, 0, self.counts[0][np.maximum(ids, 0)])
        key, back = np.unique(ids, return_inverse=True)
        result = np.zeros(len(key), np.int64)
        cuts = np.searchsorted(key, self.starts).tolist()
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                result[a:b] = self.counts[s][key[a:b] - self.starts[s]]
        return result[back]


class Level:
    """A level of n-grams, n > 1."""

    def __init__(self, model: Model, n: int):
        self.segments = segs = model.levels[n - 1]
        self.first = np.array([s.first for s in segs], np.int64)
        self.first_rel = np.array([s.first_rel for s in segs], np.int64)
        self.last = np.array([s.last for s in segs], np.int64)
        self.starts = np.cumsum([0, *[s.rows for s in segs]])
        self.carry = np.zeros(len(segs), np.int64)   # entries of the first context in earlier segments
        kept: dict[int, float] = {}                  # of contexts that span segments
        for k, s in enumerate(segs):
            if k and segs[k - 1].last == s.first:
                before = segs[k - 1]
                self.carry[k] = before.rows_last + (self.carry[k - 1] if before.first == before.last else 0)
                kept[s.first] = kept.get(s.first, before.kept_last) + s.kept_first
        self.spanning = {c: max(1e-12, 1 - v) for c, v in kept.items()}
        read = lambda s, what: _load(model.folder, f"{n}-{s.number}-{what}")
        self.pointers = [EliasFano(read(s, "low"), read(s, "high"), read(s, "ranks"), int(read(s, "bits")[0]))
                         for s in segs]
        self.successors = [read(s, "next") for s in segs]
        self.read_count = lambda s: read(segs[s], "count")      # of segments that a level above asks for
        self.codes, self.table = [read(s, "code") for s in segs], [read(s, "table") for s in segs]
        self.weights, self.weight_table = [read(s, "weight") for s in segs], [read(s, "weights") for s in segs]

    def find(self, context: np.ndarray, successor: np.ndarray):
        """(position or -1, rank among the context's successors, discounted probability, weight of the lower order)."""
        if not len(context):
            return self._find(context, successor)
        if max(int(context.max()), int(successor.max())) < (1 << 31) - 1:
            key, back = np.unique((context + 1) << 32 | (successor + 1), return_inverse=True)  # once each, neighbours in turn
            return tuple(x[back] for x in self._find((key >> 32) - 1, (key & 0xFFFFFFFF) - 1))
        order = np.lexsort((successor, context))
        at = _runs(context[order], successor[order])
        back = np.empty(len(context), np.int64)
        back[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
        return tuple(x[back] for x in self._find(context[order[at]], successor[order[at]]))

    def _find(self, context: np.ndarray, successor: np.ndarray):
        """``find`` for distinct (context, successor) in order, of which each segment holds a run."""
        n = len(context)
        position, rank = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        share, weight = np.zeros(n), np.ones(n)
        cuts, ends = np.searchsorted(context, self.first), np.searchsorted(context, self.first, side="right")
        for s in np.flatnonzero((self.carry > 0) & (cuts < ends)):  # a context that spans segments
            cuts[s] += np.searchsorted(successor[cuts[s]:ends[s]], self.first_rel[s])
        stops = np.searchsorted(context, self.last, side="right")
        for s in np.flatnonzero(cuts < np.minimum(stops, np.append(cuts[1:], n))):
            a, b = int(cuts[s]), int(min(stops[s], cuts[s + 1] if s + 1 < len(cuts) else n))
            own, wanted = _runs(context[a:b]), successor[a:b]
            local, asked = context[a:b][own] - self.first[s], np.diff(np.append(own, b - a))
            begin, end = np.split(self.pointers[s].get(np.concatenate([local, local + 1])), 2)
            weight[a:b] = np.repeat(np.where(end > begin, self.weight_table[s][self.weights[s][local]], 1.0), asked)
            of = np.repeat(np.arange(len(own)), asked)
            at, next_ = begin[of], self.successors[s]
            # contexts of which much is asked are read through, the others are searched
            through = (end - begin <= READ_THROUGH * (asked + 1)) & (next_.itemsize == 4)
            if through.any():
                sizes = np.where(through, end - begin, 0)
                upto = np.cumsum(sizes)
                entry = np.repeat(begin - upto + sizes, sizes) + np.arange(int(upto[-1]))
                keys = np.repeat(np.arange(len(own)) << 33, sizes) + next_[entry]
                some = np.flatnonzero(through[of])
                at[some] += np.searchsorted(keys, (of[some] << 33) + wanted[some]) - (upto - sizes)[of[some]]
            live = np.flatnonzero((~through & (begin < end))[of])
            left, right, sought = at[live], end[of[live]], wanted[live]
            while len(live):
                mid = (left + right) >> 1
                less = next_[mid] < sought
                left, right = np.where(less, mid + 1, left), np.where(less, right, mid)
                more = left < right
                if not more.all():
                    at[live[~more]] = left[~more]
                    live, left, right, sought = live[more], left[more], right[more], sought[more]
            hit = at < end[of]
            hit[hit] = next_[at[hit]] == wanted[hit]
            at, to = at[hit], a + np.flatnonzero(hit)
            position[to] = self.starts[s] + at
            rank[to] = at - begin[of[hit]] + np.where(context[to] == self.first[s], self.carry[s], 0)
            share[to] = self.table[s][self.codes[s][at]]
        for c, w in self.spanning.items():
            low, high = np.searchsorted(context, [c, c + 1])
            weight[low:high] = w
        return position, rank, share, weight

    def count(self, position: np.ndarray) -> np.ndarray:
        result = np.zeros(len(position), np.int64)
        order = np.argsort(position)
        cuts = np.searchsorted(position[order], self.starts).tolist()
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                result[order[a:b]] = self.read_count(s)[position[order[a:b]] - self.starts[s]]
        return result


class Reader:
    """Words and levels of a model in a worker."""

    def __init__(self, model: Model):
        self.model, self.words = model, Words(model)
        self.levels = [Level(model, n) for n in range(2, len(model.levels) + 1)]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Each text's tokens (words, then the end) as ids, 4 bytes each where they fit, else 8."""
        result, width = [], self.model.width
        for hashes, first in tokenised(texts):
            ids = self.words.find(hashes).astype(width)
            result += [x.tobytes() for x in np.split(ids, first[1:])]
        return result

    def contexts(self, token: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The context of each token at level 2."""
        context = np.empty(len(token), np.int64)
        context[1:] = token[:-1]
        context[first] = self.model.words  # the begin context
        return context

    def walk(self, token: np.ndarray, first: np.ndarray):
        """Per token and level above 1: (position, rank, share, weight of the lower order)."""
        context, successor = self.contexts(token, first), token
        for level in self.levels:
            found = level.find(context, successor)
            yield found
            context = np.empty(len(token), np.int64)
            context[1:] = found[0][:-1]
            context[first] = -1
            successor = found[1]

    def score(self, token: np.ndarray, first: np.ndarray):
        """(tokens, known tokens, base score, score) of each text; log10."""
        count = self.words.count(token)
        unigram = (count + 1) / (self.model.tokens + self.model.words + 1)
        p = unigram
        for _, _, share, weight in self.walk(token, first):
            p = share + weight * p
        return [np.add.reduceat(x, first) for x in
                (np.ones(len(token), np.int64), (count > 0).astype(np.int64), np.log10(unigram), np.log10(p))]


def slices(model: Model, tokens: list[bytes], most: int = SLICE_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts with about ``most`` tokens: their ids and each text's first place."""
    begin, size, width = 0, 0, array(model.width).itemsize
    for n, t in enumerate(tokens):
        size += len(t) // width
        if size >= most or n + 1 == len(tokens):
            own = tokens[begin:n + 1]
            yield (np.frombuffer(b"".join(own), f"i{width}").astype(np.int64),
                   np.cumsum([0, *[len(x) // width for x in own[:-1]]], dtype=np.int64))
            begin, size = n + 1, 0


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return h << _U[bits] | h >> _U[64 - bits]


def _hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of the words at ``starts`` to ``ends`` of ``raw``, which ends in 8 bytes of no word.

    A step of the hash is taken for all words at once; those of 32 bytes and more are left to the library.
    """
    size, one, two, three, four, five = len(raw), *_PRIMES
    eights, fours = (np.ndarray((size - w + 1,), f"<u{w}", raw, strides=(1,)) for w in (8, 4))
    length = ends - starts
    h, at = length.astype(np.uint64) + five, starts.copy()
    for n in range(3):
        live = np.flatnonzero((length >= 8 * n + 8) & (length < 32))
        h[live] = _turned(h[live] ^ _turned(eights[at[live]] * two, 31) * one, 27) * one + four
        at[live] += 8
    live = np.flatnonzero((length & 4 > 0) & (length < 32))
    h[live] = _turned(h[live] ^ fours[at[live]].astype(np.uint64) * one, 23) * two + three
    at[live] += 4
    for n in range(3):
        live = np.flatnonzero(((length & 3) > n) & (length < 32))
        h[live] = _turned(h[live] ^ (fours[at[live] + n] & 255).astype(np.uint64) * five, 11) * one
    for shift, factor in ((33, two), (29, three)):
        h = (h ^ h >> _U[shift]) * factor
    h ^= h >> _U[32]
    for k in np.flatnonzero(length >= 32):
        h[k] = xxhash.xxh64_intdigest(raw[starts[k]:ends[k]])
    return h.view(np.int64)


def hashed(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return _hashes(b"".join(words) + bytes(8), np.concatenate([[0], ends[:-1]]), ends)


def tokenised(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts of about ``SLICE_BYTES``: the hashes of their tokens (words, then the end) and each text's first place."""
    held, size, last = [], 0, hashed([END])
    for n, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1])
        if size < SLICE_BYTES and n + 1 < len(texts):
            continue
        raw = b"".join([b" ", b" ".join(held).lower(), bytes(b" " * 8)])
        blank = _BLANK[np.frombuffer(raw, np.uint8)]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        words = _hashes(raw, edges[::2], edges[1::2])
        upto = np.searchsorted(edges[::2], np.cumsum([len(t) + 1 for t in held], dtype=np.int64))  # words up to each text's end
        tokens = np.empty(len(words) + len(held), np.int64)
        final = upto + np.arange(len(held))
        is_word = np.ones(len(tokens), bool)
        is_word[final] = False
        tokens[is_word], tokens[final] = words, last
        yield tokens, np.concatenate([[0], final[:-1] + 1])
        held, size = [], 0


@lru_cache(maxsize=2)
def _reader(folder: str, levels: int, model: str) -> Reader:
    import pickle

    return Reader(pickle.loads(bytes.fromhex(model)))


def reader(model: Model) -> Reader:
    import pickle

    if "reader" not in model.__dict__:  # pickled once a task, not once a slice
        model.__dict__["reader"] = _reader(model.folder, len(model.levels), pickle.dumps(model).hex())
    return model.__dict__["reader"]


def _model_folder(spark: SparkSession) -> str:
    path = scratch(spark, "lm")
    local = path[7:] if path.startswith("file://") else path[5:] if path.startswith("file:") else path
    if "://" in local:
        raise RuntimeError(f"the trie is memory-mapped: mount the shared folder as a file path, not {path}")
    os.makedirs(local, exist_ok=True)
    return local


def _gather(batches: Iterable[pa.RecordBatch]) -> list[np.ndarray]:
    """All columns of a partition as long arrays."""
    kept = list(batches)
    if not kept:
        return []
    return [np.concatenate([b.column(c).to_numpy() for b in kept]) for c in range(kept[0].num_columns)]


_MANIFEST = ("number int, rows long, first long, first_rel long, last long, rows_first long, rows_last long, "
             "kept_first double, kept_last double")


_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
_MANIFEST_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in _MANIFEST.split(", "))])


def _manifest(values: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _MANIFEST_SCHEMA)],
                                      schema=_MANIFEST_SCHEMA)


def _write_words(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _gather(batches)
        if columns:
            h, c = columns
            number = TaskContext.get().partitionId()
            _save(folder, f"1-{number}-hash", h)
            _save(folder, f"1-{number}-count", c)
            yield _manifest((number, len(h), int(h[0]), 0, int(h[-1]), 0, 0, 0.0, 0.0))
    return run


def _write_level(model: Model, n: int, discount: float, below: bool):
    """Writer of segments of level n; counts only if it is ``below`` another level, which reads them."""
    def run(number: int, context: np.ndarray, successor: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        own = reader(model)
        at = _runs(context)
        distinct, sizes = context[at], np.diff(np.append(at, len(context)))
        where = np.repeat(np.arange(len(at)), sizes)
        if n == 2:
            totals = own.words.count(np.where(distinct < model.words, distinct, -1))
            totals = np.where(distinct == model.words, model.documents, totals)
        else:
            totals = own.levels[n - 3].count(distinct)
        share = (count - discount) / totals[where]
        kept = np.bincount(where, share)
        first, last = int(distinct[0]), int(distinct[-1])
        rows = np.zeros(last - first + 1, np.int64)
        rows[distinct - first] = sizes
        ef = EliasFano.build(np.concatenate([[0], np.cumsum(rows)]))
        weight = np.ones(len(rows))
        weight[distinct - first] = np.maximum(1e-12, 1 - kept)
        codes, values = quantise(share)
        weights, weight_values = quantise(weight)
        narrow = np.uint32 if int(successor.max()) < 1 << 32 else np.int64
        counts = count.astype(np.uint32 if int(count.max()) < 1 << 32 else np.int64)
        for what, array in (("low", ef.low), ("high", ef.high), ("ranks", ef.ranks), ("bits", np.array([ef.bits])),
                            ("next", successor.astype(narrow)), ("code", codes), ("table", values),
                            ("weight", weights), ("weights", weight_values), *([("count", counts)] if below else [])):
            _save(model.folder, f"{n}-{number}-{what}", array)
        return _manifest((number, len(context), first, int(successor[0]), last, int(sizes[0]), int(sizes[-1]),
                          float(kept[0]), float(kept[-1])))
    return run


def _segments(manifests: DataFrame) -> list[Segment]:
    """Have the segments written; their manifests, in order."""
    found = written(manifests, "manifest").collect()
    return sorted((Segment(**r.asDict()) for r in found), key=lambda s: (s.first, s.first_rel))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers from 0, 4 bytes each where they fit, else 8."""
    press = zstd.ZstdCompressor(level=1)
    narrow = [x.astype("<u4" if int(x.max(initial=0)) < 1 << 32 else "<i8") for x in arrays]
    parts = [bytes([x.itemsize]) + press.compress(x.tobytes()) for x in narrow]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unpack(blob: bytes) -> list[np.ndarray]:
    parts, at, press = [], 0, zstd.ZstdDecompressor()
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 8], "little")
        raw = press.decompress(blob[at + 9:at + 8 + size])
        parts.append(np.frombuffer(raw, "<u4" if blob[at + 8] == 4 else "<i8").astype(np.int64))
        at += 8 + size
    return parts


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = keys[0][1:] != keys[0][:-1]
    for k in keys[1:]:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _tally(context: np.ndarray, successor: np.ndarray):
    """Distinct (context, successor), sorted, and how often each occurs."""
    rows = len(context)
    if rows and max(int(context.max()), int(successor.max())) < 1 << 31:
        key = np.sort(context << 32 | successor)  # one plain sort where both fit
        at = _runs(key)
        context, successor = key[at] >> 32, key[at] & 0xFFFFFFFF
    else:
        order = np.lexsort((successor, context))
        context, successor = context[order], successor[order]
        at = _runs(context, successor)
        context, successor = context[at], successor[at]
    return context, successor, np.diff(np.append(at, rows))


def _dealt(held: list[tuple[np.ndarray, np.ndarray]], bounds: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a run of texts, dealt by ranges that begin at ``bounds``; counts of 1 are not spelled out."""
    context, successor, count = _tally(*[np.concatenate(x) for x in zip(*held)])
    cuts = [0]
    for c, s in bounds:
        low, high = np.searchsorted(context, [c, c + 1])
        cuts.append(int(low + np.searchsorted(successor[low:high], s)))
    for n, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(context)])):
        if a < b:
            often = np.flatnonzero(count[a:b] > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()),
                 pa.array([_pack(np.diff(context[a:b], prepend=0), successor[a:b], often, count[a:b][often])], pa.binary())],
                names=["shard", "grams"])


def _summed(rows: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of a range's n-grams, of those that occur at least ``least`` times, sorted."""
    parts = []
    for blob in rows["grams"].to_pylist():
        step, successor, often, times = _unpack(blob)
        count = np.ones(len(step), np.int64)
        count[often] = times
        parts.append((np.cumsum(step), successor, count))
    context, successor, count = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    if max(int(context.max()), int(successor.max())) < 1 << 31:
        order = np.argsort(context << 32 | successor)
    else:
        order = np.lexsort((successor, context))
    context, successor = context[order], successor[order]
    at = _runs(context, successor)
    total = np.add.reduceat(count[order], at)
    keep = total >= least
    return context[at[keep]], successor[at[keep]], total[keep]


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, packed tightly, and its path, to be deleted after its use."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _grams(own: Reader, token: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, successor) of the n-grams of order n in a slice of texts."""
    if n == 2:
        context, successor = own.contexts(token, first), token
    else:
        *_, (position, successor, _, _) = own.walk(token, first)
        context = np.empty(len(token), np.int64)
        context[1:], context[first] = position[:-1], -1
    good = (context >= 0) & (successor >= 0)
    return context[good], successor[good]


def _bounds(tokens: DataFrame, model: Model, n: int) -> list[tuple[int, int]]:
    """Where ranges of n-grams of order n begin, each of about ``SEGMENT_ROWS`` tokens, but the first.

    From tokens drawn among all; only what is drawn is looked up, and about
    ``RANGE_KEYS`` n-grams for each range reach the driver.
    """
    ranges = -(-model.tokens // SEGMENT_ROWS)
    if ranges < 2:
        return []
    share = RANGE_KEYS * ranges / model.tokens

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, own = np.random.default_rng(TaskContext.get().partitionId()), reader(model)
        for batch in batches:
            for token, first in slices(model, batch.column(0).to_pylist()):
                at = np.flatnonzero(rng.random(len(token)) < share)
                context = own.contexts(token, first)
                if n == 2:
                    context, successor = context[at], token[at]
                else:
                    at = at[~np.isin(at, first)]
                    successor = own.levels[0].find(context[at], token[at])[1]
                    context = own.levels[0].find(context[at - 1], token[at - 1])[0]
                good = (context >= 0) & (successor >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(context[good]), pa.array(successor[good])],
                                                 names=["context", "successor"])

    drawn = tokens.select("tokens").mapInArrow(draw, "context long, successor long").toArrow()
    context, successor = (c.to_numpy() for c in drawn.columns)
    order = np.lexsort((successor, context))[np.arange(1, ranges) * len(context) // ranges] if len(context) else []
    return sorted(set(zip(context[order].tolist(), successor[order].tolist()))) if len(order) else []


def _counted(tokens: DataFrame, model: Model, n: int, least: int, write) -> DataFrame:
    """Manifests of the segments that ``write`` makes of the n-grams of order n that occur at least ``least`` times."""
    bounds = _bounds(tokens, model, n)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for token, first in slices(model, batch.column(0).to_pylist()):
                held.append(_grams(reader(model), token, first, n))
                rows += len(held[-1][0])
                if rows > RUN_GRAMS:
                    yield from _dealt(held, bounds)
                    held, rows = [], 0
        if rows:
            yield from _dealt(held, bounds)

    def segment(key: tuple, rows: pa.Table) -> pa.Table:
        grams = _summed(rows, least)
        found = [write(key[0].as_py(), *grams)] if len(grams[0]) else []
        return pa.Table.from_batches(found, schema=_MANIFEST_SCHEMA)

    blobs = tokens.select("tokens").mapInArrow(count, "shard int, grams binary")
    return blobs.groupBy("shard").applyInArrow(segment, _MANIFEST)


def vocabulary(docs: DataFrame) -> Model:
    """Level 1 from all texts of ``docs``: a model of order 1, in the shared folder."""
    spark = docs.sparkSession
    ship(spark)

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for hashes, _ in tokenised(utf8(batch, "text")):
                held.append(np.unique(hashes, return_counts=True))
                rows += len(held[-1][0])
                if rows > 2 * REMEMBERED:
                    held = [_totals(held)]
                    rows = len(held[0][0])
                    if rows > REMEMBERED:
                        yield _word_rows(*held[0])
                        held, rows = [], 0
        if held:
            yield _word_rows(*_totals(held))

    texts = docs.select(F.col("text").cast("string").alias("text"))
    counts, path = _stored(texts.mapInArrow(words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = counts.where(F.col("h") == F.lit(int(hashed([END])[0]))).first()
    model = Model(_model_folder(spark), int(total["n"] or 0), int(total["v"]), int(ends["c"]) if ends else 0, [])
    if model.words:
        spread = counts.repartitionByRange(-(-model.words // SEGMENT_ROWS), "h").sortWithinPartitions("h")
        model.levels.append(_segments(spread.mapInArrow(_write_words(model.folder), _MANIFEST)))
    else:
        model.levels.append([])
    delete_folder(spark, path)
    return model


def encoded(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """(doc_id, *columns, tokens): every whole text as word ids (-1: unknown)."""
    rows = docs.select("doc_id", *columns, F.col("text").cast("string").alias("text"))
    names = rows.columns[:-1]

    def run(batch: pa.RecordBatch) -> dict:
        return {n: batch.column(i) for i, n in enumerate(names)} | {"tokens": reader(model).encode(utf8(batch))}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return arrow_map(rows, run, f"{fields}, tokens binary")


def learn(tokens: DataFrame, model: Model, order: int = ORDER, discount: float = DISCOUNT,
          least: int = LEAST_COUNT) -> Model:
    """Levels 2 to ``order`` from ``encoded`` training texts, added to the vocabulary's model."""
    if order not in (1, 2, 3):
        raise ValueError("orders 1 to 3")
    for n in range(2, order + 1 if model.tokens else 0):
        segments = _segments(_counted(tokens, model, n, least, _write_level(model, n, discount, n < order)))
        model = replace(model, levels=[*model.levels, segments])
    return model


def _totals(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of several runs, sorted, and their counts."""
    hashes, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(hashes)
    at = _runs(hashes[order])
    return hashes[order][at], np.add.reduceat(counts[order], at)


def _word_rows(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts, pa.int64())], names=["h", "c"])


def forget(model: Model) -> None:
    """Delete a model's files once nothing reads them."""
    shutil.rmtree(model.folder)


def scored(tokens: DataFrame, model: Model, *columns: str) -> DataFrame:
    """(doc_id, *columns, n_tokens, n_known, base_score, score) of ``encoded`` texts."""
    names = ["doc_id", *columns]

    def run(batch: pa.RecordBatch) -> dict:
        parts = [reader(model).score(token, first) for token, first in slices(model, batch.column(len(names)).to_pylist())]
        count, known, base, score = (np.concatenate(x) for x in zip(*parts))
        return {n: batch.column(i) for i, n in enumerate(names)} | {
            "n_tokens": pa.array(count), "n_known": pa.array(known), "base_score": pa.array(base), "score": pa.array(score)}

    rows = tokens.select(*names, "tokens")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "tokens")
    return arrow_map(rows, run, f"{fields}, n_tokens long, n_known long, base_score double, score double")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn(
        "held_out", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)))
    model = vocabulary(docs.where("NOT held_out"))
    tokens = written(encoded(docs, model, "held_out"), "tokens")
    model = learn(tokens.where("NOT held_out"), model)
    return scored(tokens, model, "held_out").select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
