"""BPE encoding and decoding by prefix-sharing trie traversal.

Texts are cut into the byte-level pre-tokenizer's words. The distinct words of
a batch that are not known yet form a byte trie, and one depth-first walk
carries for every prefix the last token of its encoding. That token is the one
token t ending there that is compatible with the last token of the prefix
before t: merging the two tokens' bytes on their own gives just these two
tokens again. So a shared prefix is solved once, and a word's ids are read off
by jumping back token by token.

Everything is local to a document, so there is no shuffle; a lost executor only
repeats its own splits. Memory is bounded by the batch and by the number of
remembered words (``REMEMBERED``, after which a worker starts afresh).

Cases: a null text is an empty text (no ids, decodes to the empty text);
special tokens of the vocabulary are recognised inside texts; words of any
length are walked iteratively. Input columns other than id and text are not read.
"""

from __future__ import annotations

import gc
import json
from array import array
from collections.abc import Iterable
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, table

REMEMBERED = 150_000
VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: the byte-level pre-tokenizer's pattern, as published with the vocabulary.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


_MARKS = frozenset(".,;:!?")


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.id_of = {self.bytes_of[i]: i for t, i in vocab.items() if t not in self.special}
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        top = max(self.bytes_of) + 1
        self.rank, self.left, self.right = [-1] * top, [-1] * top, [-1] * top
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ia, ib, merged = vocab[a], vocab[b], vocab[a + b]
            self.rank_of_pair[ia, ib] = rank
            self.rank[merged], self.left[merged], self.right[merged] = rank, ia, ib
        self._build_endings()

    def _build_endings(self) -> None:
        """Automaton of token endings: a state per token prefix, the tokens that end there.

        ``step`` holds the known moves, keyed by state * 256 + byte; others are
        found over the fail links on first use and then remembered.
        """
        self.step: dict[int, int] = {}
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        self.fail = [0]
        whole: dict[int, tuple[int, int]] = {}
        layer: list[tuple[int, int, int]] = []
        for token, i in sorted(self.id_of.items(), key=lambda x: len(x[0])):
            state = 0
            for depth, byte in enumerate(token):
                move = state << 8 | byte
                if move not in self.step:
                    self.step[move] = len(self.fail)
                    layer.append((depth, state, byte))
                    self.fail.append(0)
                    self.ending.append(())
                state = self.step[move]
            whole[state] = (i, len(token))
        for depth, parent, byte in sorted(layer):
            state = self.step[parent << 8 | byte]
            if depth:
                at = self.fail[parent]
                while at and (at << 8 | byte) not in self.step:
                    at = self.fail[at]
                self.fail[state] = self.step.get(at << 8 | byte, 0)
            own = (whole[state],) if state in whole else ()
            self.ending[state] = own + self.ending[self.fail[state]]

    def move(self, state: int, byte: int) -> int:
        at = state
        while at and (at << 8 | byte) not in self.step:
            at = self.fail[at]
        self.step[state << 8 | byte] = to = self.step.get(at << 8 | byte, 0)
        return to

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b, encoded together, are just a and b.

        Merges are undone youngest first; the pair fails if, at some point,
        the two tokens that touch would have been merged earlier.
        """
        rank, pairs, limit = self.rank, self.rank_of_pair, 1 << 60
        while True:
            if pairs.get((a, b), 1 << 60) < limit:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            else:
                limit, b = rank[b] + 1, self.left[b]


class TrieEncoder:
    """Ids of texts; remembers the words it has solved."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.v, self.remembered = vocabulary, remembered
        self.shown = [str(i) for i in range(max(vocabulary.bytes_of) + 1)]
        self.words: dict[str, bytes] = {}
        self.after_space: dict[str, bytes] = {}
        self.agree: dict[int, dict[int, bool]] = {}  # token -> token before it -> compatible
        self.pattern = regex.compile(WORDS)
        #: A space before a non-space begins a word whatever surrounds it.
        self.parts = regex.compile(r"(?: (?=\S))?(?:[^ ]| (?!\S))+")
        self.odd = regex.compile(r" (?!\S)")
        special = "|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))
        self.special = regex.compile(f"({special})") if special else None

    def solve(self, words: Iterable[str]) -> None:
        """Encode distinct words depth first over their byte trie.

        Sorted words are the trie's leaves in depth-first order: what a word
        shares with the one before it is the path down to their fork, so the
        states up to the fork stay and only the new branch is walked.
        """
        step, move, ending = self.v.step, self.v.move, self.v.ending
        agree, compatible, solved = self.agree, self.v.compatible, self.words
        before = b""
        last, states = [(-1, 0)], [0]  # per depth of the path: last token and its length, ending state
        for word in sorted(words):  # code points sort as their UTF-8 bytes do
            key = word.encode()
            fork = 0
            for x, y in zip(before, key):
                if x != y:
                    break
                fork += 1
            del last[fork + 1:], states[fork + 1:]
            state, depth = states[fork], fork
            for byte in key[fork:]:
                depth += 1
                to = step.get(state << 8 | byte)
                state = move(state, byte) if to is None else to
                states.append(state)
                for found in ending[state]:
                    token, n = found
                    if n == depth:
                        break
                    previous = last[depth - n][0]
                    known = agree.get(token)
                    if known is None:
                        known = agree[token] = {}
                    ok = known.get(previous)
                    if ok is None:
                        ok = known[previous] = compatible(previous, token)
                    if ok:
                        break
                last.append(found)
            ids, at = [], depth
            while at:
                token, n = last[at]
                ids.append(token)
                at -= n
            ids.reverse()
            solved[word] = array("i", ids).tobytes()
            before = key

    def learn(self, parts: set[str]) -> None:
        """Ids of text parts that follow a space (keys without that space)."""
        split = {p: self._words(p) for p in parts}
        words = self.words
        self.solve({w for ws in split.values() for w in ws if w not in words})
        for p, ws in split.items():
            self.after_space[p] = b"".join([words[w] for w in ws])

    def _words(self, part: str) -> list[str]:
        """The pre-tokenizer's words of a space and ``part``."""
        if part.isalpha():  # letters, and letters with one mark behind them, need no pattern
            return [" " + part]
        if part[-1:] in _MARKS and part[:-1].isalpha():
            return [" " + part[:-1], part[-1]]
        return self.pattern.findall(" " + part)

    def _ordinary(self, text: str, out: list[bytes]) -> None:
        """Append the ids of a text without special tokens; its parts are known."""
        first, parts = self._parts(text)
        if first:
            ws = self.pattern.findall(first)
            if new := {w for w in ws if w not in self.words}:
                self.solve(new)
            out.extend(self.words[w] for w in ws)
        out.extend(map(self.after_space.__getitem__, parts))

    def _parts(self, text: str) -> tuple[str, list[str]]:
        """The text before its first word-opening space, and what follows each such space."""
        if self.odd.search(text) is None:
            first, *parts = text.split(" ")
            return first, parts
        parts = self.parts.findall(text)
        first = "" if not parts or (parts[0][0] == " " and len(parts[0]) > 1 and not parts[0][1].isspace()
                                    and self.odd.match(parts[0]) is None) else parts.pop(0)
        return first, [p[1:] for p in parts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, in order."""
        if len(self.after_space) > self.remembered or len(self.words) > self.remembered:
            self.words.clear()
            self.after_space.clear()
            self.agree.clear()
        pieces = [[""] if not t else self.special.split(t) if self.special else [t] for t in texts]
        known = self.after_space
        new = {p for own in pieces for piece in own if piece not in self.v.special
               for p in self._parts(piece)[1] if p not in known}
        if new:
            self.learn(new)
        result = []
        for own in pieces:
            out: list[bytes] = []
            for piece in own:
                if piece in self.v.special:
                    out.append(array("i", [self.v.special[piece]]).tobytes())
                elif piece:
                    self._ordinary(piece, out)
            result.append(np.frombuffer(b"".join(out), np.int32))
        return result


_ENCODERS: dict[tuple[str, int], TrieEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> TrieEncoder:
    """One encoder per worker process and vocabulary file."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = TrieEncoder(Vocabulary(path), remembered)
        gc.freeze()  # the tables live as long as the worker; collections need not visit them
    return _ENCODERS[path, remembered]


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def decode_bytes(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id",
           text_column: str = "text", batch: int = 2048) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text."""
    file = path or default_vocabulary()

    def run(rows: pa.RecordBatch) -> dict:
        enc, texts = encoder(file), rows.column(1).to_pylist()
        ids = [x for at in range(0, len(texts), batch) for x in enc.encode(texts[at:at + batch])]
        return {"doc_id": rows.column(0), "ids": id_lists(ids)}

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the text of every id list."""
    file = path or default_vocabulary()

    def run(rows: pa.RecordBatch) -> dict:
        v, lists = encoder(file).v, rows.column(1)
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        return {"doc_id": rows.column(0), "ids": lists,
                "text": [decode_bytes(v, flat[a:b].tolist()) for a, b in zip(ends, ends[1:])]}

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_map(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids array<int>, text string")


def digests(docs: DataFrame, path: str | None = None, batch: int = 2048) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of every text's ids and of the text
    decoded from them, in one pass that keeps the ids in the worker."""
    file = path or default_vocabulary()

    def run(rows: pa.RecordBatch) -> dict:
        enc, texts = encoder(file), rows.column(1).to_pylist()
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for at in range(0, len(texts), batch):
            for ids in enc.encode(texts[at:at + batch]):
                own = ids.tolist()
                out["n_tokens"].append(len(own))
                out["ids_sha256"].append(sha256(",".join(map(enc.shown.__getitem__, own)).encode()).hexdigest())
                out["decoded_sha256"].append(sha256(decode_bytes(enc.v, own).encode()).hexdigest())
        return {"doc_id": rows.column(0)} | out

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    return digests(table(spark, sf_dir, "documents", "doc_id", "text"))
