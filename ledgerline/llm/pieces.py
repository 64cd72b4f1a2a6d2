"""SentencePiece encoding and decoding that keeps every piece's place in the source.

A text is normalised by the model's compiled character map (a double-array
trie): at every place the longest key that begins there is replaced, and each
character of the result remembers the source byte it stands for. Blanks become
``▁`` and one goes in front. Byte-pair merges then run over segments between
which no merge can happen: no piece has ``▁`` behind another character, and
line ends are in no piece. Merged pieces know how many normalised characters
they cover, so the remembered places project every piece to a span of source
bytes (``begins``, ``ends``; a piece without source, such as the blank in
front, has an empty span; of a character spelled in byte pieces the last one
has it). Decoding joins the pieces and takes the blank in front away again.

Everything is local to a document: there is no shuffle, and a lost executor
only repeats its splits. Segments are solved once per worker and remembered
(``REMEMBERED`` of them, after which the worker starts afresh).

Cases: a null text is an empty text: the end id alone, which decodes to the
empty text. Spellings of control pieces in a text are ordinary text. Segments
of any length are merged over a heap. Byte pieces that are no UTF-8 decode to
one replacement character a byte. Models with pieces of other kinds than
ordinary, byte, control and unknown ones are refused. Other columns than id
and text are not read.
"""

from __future__ import annotations

import gc
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, table

REMEMBERED = 1_000_000
MODEL = "piece_bpe_32k.model"
BLANK = "▁"
NEVER = float("-inf")
#: Segments up to this length are merged by looking at every pair.
SHORT = 40
# Kinds of pieces, and of models (fixed values of the model file's format).
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


# --- the model file ------------------------------------------------------------

def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields as they are encoded."""
    at = 0
    while at < len(raw):
        key, at = _number(raw, at)
        if key & 7 == 0:
            value, at = _number(raw, at)
        else:
            if key & 7 == 2:
                size, at = _number(raw, at)
            else:
                size = 4 if key & 7 == 5 else 8
            value = raw[at:at + size]
            at += size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a trie over keys' bytes, and the texts that replace them."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.texts = compiled[4 + size:] if compiled else b""
        self.inert: dict[str, bool] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[str, int] | None:
        """The replacement of the longest key that begins at ``at``, and the key's length."""
        units, found = self.units, None
        if not units:
            return None
        node = self._offset(units[0])
        for k in range(at, len(raw)):
            node ^= raw[k]
            unit = units[node]
            if unit & 0x800000FF != raw[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.texts[start:self.texts.index(b"\0", start)].decode(), found[1]

    def untouched(self, text: str) -> bool:
        """Whether no key begins with any character of ``text``."""
        return not self.units or all(map(self._inert, set(text)))

    def _inert(self, character: str) -> bool:
        known = self.inert.get(character)
        if known is None:
            node, units, known = self._offset(self.units[0]), self.units, False
            for byte in character.encode():
                node ^= byte
                unit = units[node]
                if unit & 0x800000FF != byte:
                    known = True
                    break
                node ^= self._offset(unit)
                if unit >> 8 & 1:
                    break
            self.inert[character] = known
        return known


class Model:
    """Pieces, scores and normalisation rules of a byte-pair model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.read(f.read())

    def read(self, raw: bytes) -> None:
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.surface: list[bytes] = []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        self.unknown, kinds = 0, set()
        self.control: set[int] = set()
        for number, value in fields(raw):
            if number == 1:
                own = dict(fields(value))
                kind, piece = own.get(3, NORMAL), own[1].decode()
                kinds.add(kind)
                n = len(self.surface)
                if kind == NORMAL:
                    self.id_of[piece] = n
                    self.score[piece] = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                    self.surface.append(piece.replace(BLANK, " ").encode())
                elif kind == BYTE:
                    self.byte_id[int(piece[1:-1], 16)] = n
                    self.surface.append(bytes([int(piece[1:-1], 16)]))
                else:
                    self.unknown = n if kind == UNKNOWN else self.unknown
                    self.control |= {n} if kind == CONTROL else set()
                    self.surface.append(b"")
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                rules = dict(fields(value))
        if trainer.get(3, 1) != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or trainer.get(24, 0):
            raise ValueError("not a byte-pair model of ordinary, byte, control and unknown pieces")
        self.blank_first = {i for p, i in self.id_of.items() if p[0] == BLANK}
        self.surface[self.unknown] = trainer.get(44, " ⁇ ".encode())
        self.end = trainer.get(42, 2)
        self.spell = bool(trainer.get(35, 0))
        self.front, self.squeeze, self.escape = (bool(rules.get(k, 1)) for k in (3, 4, 5))
        self.map = CharacterMap(rules.get(2, b""))
        #: Characters between and around which no merge can happen.
        letters = set().union(*self.id_of)
        self.apart = "".join(c for c in "\n\r\t" if c not in letters)
        #: Marks that no piece has behind an ASCII letter.
        self.marks = "".join(c for c in ".,;:!?" if not any(re.search("[A-Za-z]" + re.escape(c), p) for p in self.id_of))
        if any(BLANK in p.lstrip(BLANK) for p in self.id_of) or not self.escape:
            raise ValueError("pieces that go on behind a blank are not supported")


# --- normalisation -------------------------------------------------------------

def normalised(model: Model, text: str) -> tuple[str, np.ndarray]:
    """The normalised text, and per character of it the source byte it stands for (and the end)."""
    if not text:
        return "", np.zeros(1, np.int64)
    if not model.squeeze and model.map.untouched(text):
        if text.isascii():
            starts = np.arange(len(text) + 1, dtype=np.int64)
        else:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        out = text.replace(" ", BLANK)
        return (BLANK + out, np.concatenate([[0], starts])) if model.front else (out, starts)
    raw = text.encode()
    out, starts, at = [], [], 0

    def step(at: int) -> tuple[str, int]:
        found = model.map.longest(raw, at)
        if found is None:
            lead = raw[at]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return raw[at:at + size].decode(), size
        return found

    if model.squeeze:
        while at < len(raw):
            into, size = step(at)
            if into != " ":
                break
            at += size
        if at == len(raw):
            return "", np.full(1, at, np.int64)
    if model.front:
        out.append(BLANK)
        starts.append(at)
    blank = model.squeeze
    while at < len(raw):
        into, size = step(at)
        if blank:
            into = into.lstrip(" ")
        if into:
            out.append(into)
            starts.extend([at] * len(into))
            blank = model.squeeze and into[-1] == " "
        at += size
    done = "".join(out).replace(" ", BLANK)
    if model.squeeze:
        kept = done.rstrip(BLANK)
        if len(kept) < len(done):
            at = starts[len(kept)]
            done, starts = kept, starts[:len(kept)]
    return done, np.array([*starts, at], np.int64)


# --- encoding --------------------------------------------------------------------

class Encoder:
    """Ids and source spans of texts; remembers the segments it has solved."""

    def __init__(self, model: Model, remembered: int = REMEMBERED):
        self.model, self.remembered = model, remembered
        #: segment -> its ids and the characters each covers, both as int32 bytes, and the ids as text
        self.known: dict[str, tuple[bytes, bytes, str]] = {}
        apart, marks = re.escape(model.apart), re.escape(model.marks)
        self.segments = re.compile(
            (f"{BLANK}+[A-Za-z]+(?=[{marks}])|" if marks else "")
            + f"{BLANK}+[^{BLANK}{apart}]*|[^{BLANK}{apart}]+" + (f"|[{apart}]+" if apart else ""))

    def merged(self, segment: str) -> list[str]:
        """The segment's symbols after all merges, best score first, leftmost among equals."""
        symbols = list(segment)
        if len(symbols) > SHORT:
            return self._merged_long(symbols)
        score = self.model.score.get
        scores = [score(a + b, NEVER) for a, b in zip(symbols, segment[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            del scores[at]
            both = symbols[at] = symbols[at] + symbols.pop(at + 1)
            if at:
                scores[at - 1] = score(symbols[at - 1] + both, NEVER)
            if at < len(scores):
                scores[at] = score(both + symbols[at + 1], NEVER)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        score, size = self.model.score, len(symbols)
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        heap = [(-s, k, a + b) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                if (s := score.get(a + b)) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, both = heapq.heappop(heap)
            n = after[k]
            if n < 0 or not symbols[k] or symbols[k] + symbols[n] != both:
                continue        # one of the two has been merged meanwhile
            symbols[k], symbols[n] = both, ""
            after[k] = after[n]
            if after[k] >= 0:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right >= 0:
                    pair = symbols[left] + symbols[right]
                    if (s := score.get(pair)) is not None:
                        heapq.heappush(heap, (-s, left, pair))
        return [s for s in symbols if s]

    def solve(self, segment: str) -> tuple[bytes, bytes, str]:
        symbols = self.merged(segment)
        ids = list(map(self.model.id_of.get, symbols))
        covers = list(map(len, symbols))
        if None in ids:
            ids, covers = self._spelled(symbols)
        return array("i", ids).tobytes(), array("i", covers).tobytes(), " ".join(map(str, ids)) + " "

    def _spelled(self, symbols: list[str]) -> tuple[list[int], list[int]]:
        """Ids and covers where some symbols are no pieces: their bytes, or the unknown id."""
        model, ids, covers = self.model, [], []
        for symbol in symbols:
            found = model.id_of.get(symbol)
            if found is None and model.spell:
                spelled = symbol.encode()
                ids.extend(model.byte_id[b] for b in spelled)
                covers.extend([0] * (len(spelled) - 1) + [len(symbol)])
            else:
                ids.append(model.unknown if found is None else found)
                covers.append(len(symbol))
        return ids, covers

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """Ids with the end id, first and end source byte of each, and the ids as text."""
        model, known = self.model, self.known
        if len(known) > self.remembered:
            known.clear()
        shaped, starts = normalised(model, text or "")
        parts = self.segments.findall(shaped)
        try:
            found = list(map(known.__getitem__, parts))
        except KeyError:
            for p in set(parts):
                if p not in known:
                    known[p] = self.solve(p)
            found = list(map(known.__getitem__, parts))
        ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
        last = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), np.int32))
        ids, begins, ends = self._joined(ids, starts[np.concatenate([[0], last])])
        return ids, begins, ends, "".join([f[2] for f in found]) + str(model.end)

    def _joined(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without spelling, unknown pieces side by side are one; the end id has an empty span at the end."""
        begins, ends = at[:-1], at[1:]
        if not self.model.spell and len(ids):
            first = np.concatenate([[True], (ids[1:] != ids[:-1]) | (ids[1:] != self.model.unknown)])
            ids, begins = ids[first], begins[first]
            ends = ends[np.concatenate([first[1:], [True]])]
        return np.append(ids, np.int32(self.model.end)), np.append(begins, at[-1]), np.append(ends, at[-1])


def decode_bytes(model: Model, ids: list[int]) -> bytes:
    """The text of ids, in UTF-8; the blank in front goes if the first piece brings it.

    A control piece has no text, but byte pieces around it do not join.
    """
    ids = ids[:-1] if ids and ids[-1] == model.end else ids
    runs = [ids]
    if not model.control.isdisjoint(ids):
        cuts = [k for k, i in enumerate(ids) if i in model.control]
        runs = [ids[a:b] for a, b in zip([0, *(k + 1 for k in cuts)], [*cuts, len(ids)])]
    out = []
    for run in runs:
        raw = b"".join(map(model.surface.__getitem__, run))
        if not any(out) and model.front and raw[:1] == b" " and run[0] in model.blank_first:
            raw = raw.lstrip(b" ") if model.squeeze else raw[1:]
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = _repaired(raw)
        out.append(raw)
    return b"".join(out)


def _repaired(raw: bytes) -> bytes:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode().encode())
            break
        except UnicodeDecodeError as e:
            out += [raw[at:at + e.start], "�".encode()]
            at += e.start + 1
    return b"".join(out)


# --- on Spark --------------------------------------------------------------------

_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per worker process and model file."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = Encoder(Model(path), remembered)
        gc.freeze()     # the tables live as long as the worker; collections need not visit them
    return _ENCODERS[path, remembered]


def _rows(docs: DataFrame) -> tuple[DataFrame, str]:
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows, rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, begins, ends): ids of every whole text and their spans of its UTF-8 bytes."""
    file = path or default_model()

    def run(batch: pa.RecordBatch) -> dict:
        found = [encoder(file).encode(t) for t in batch.column(1).to_pylist()]
        sizes = np.cumsum([0, *(len(f[0]) for f in found)])
        return {"doc_id": batch.column(0)} | {
            name: pa.ListArray.from_arrays(pa.array(sizes, pa.int32()),
                                           pa.array(np.concatenate([f[k] for f in found]), pa.int32()))
            for k, name in enumerate(("ids", "begins", "ends"))}

    rows, kind = _rows(docs)
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text): the text of every list of ``ids``."""
    file = path or default_model()

    def run(batch: pa.RecordBatch) -> dict:
        model = encoder(file).model
        return {"doc_id": batch.column(0), "text": [decode_bytes(model, ids or []).decode() for ids in batch.column(1).to_pylist()]}

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_map(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of every text's ids, spans and decoded text, in one pass that keeps the ids in the worker.

    doc_id, n_tokens, ids_sha256 (ids joined by a blank), decoded_sha256, n_empty (ids with an
    empty span: bytes of a character before its last, and pieces without source) and spans_sha256
    (first and end source byte of every id, as little-endian 64-bit numbers).
    """
    file = path or default_model()

    def run(batch: pa.RecordBatch) -> dict:
        enc = encoder(file)
        out: dict[str, list] = {c: [] for c in ("n_tokens", "ids_sha256", "decoded_sha256", "n_empty", "spans_sha256")}
        for text in batch.column(1).to_pylist():
            ids, begins, ends, spelled = enc.encode(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha256(spelled.encode()).hexdigest())
            out["decoded_sha256"].append(sha256(decode_bytes(enc.model, ids.tolist())).hexdigest())
            out["n_empty"].append(int((begins == ends).sum()))
            out["spans_sha256"].append(sha256(np.column_stack([begins, ends]).astype("<i8").tobytes()).hexdigest())
        return {"doc_id": batch.column(0)} | out

    rows, kind = _rows(docs)
    return arrow_map(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                                "n_empty long, spans_sha256 string")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return digests(table(spark, sf_dir, "documents", "doc_id", "text"))
