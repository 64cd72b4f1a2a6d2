"""Personal data: base patterns plus a character-level BiLSTM-CRF.

The base patterns (e-mail, IP address, card, phone) find their spans by linear
scans. A bidirectional LSTM over characters with CRF transitions, trained here
in numpy on windows labelled with base spans and with variants of them that the
patterns miss (``respelled``: other separators and prefixes), reads every whole
text in overlapping windows. Spans that two windows see alike are merged; a
span that touches a window's edge is decoded again in a window centred on it (spans of up to 200 code points). All spans of a
text are then reconciled together: base spans stay, model spans that touch
nothing better are added in the order of their margin. A model span must be
more confident than any wrong span of its kind on validation windows.

Windows without any chance of a span are not decoded by Viterbi: if no
character's margin over "outside" can pay for leaving and re-entering, the
all-outside path is the best one, exactly. The LSTM reads all of them.

Bounded sample: the model is trained on windows from at most ``FIT_DOCS``
distinct texts with a likely base span and ``FIT_OTHERS`` with digits or signs
alone (by hash of the text; copies count once) and at most ``FIT_WINDOWS``
windows; texts over ``FIT_BYTES`` bytes are read, but not trained on. A fifth of the windows sets the margin;
if that is fewer than ``LEAST_CHECKED``, there is no model. Scanning covers all rows and whole texts,
document by document, without a shuffle.

Cases: a null or empty text has no spans; null ids keep their row; repeated
rows get the same spans; without base spans in the corpus there is nothing to
train on (or too little) and only base spans are returned; empty tables give no rows. Only id
and text are read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, hash_sample, table, written

KINDS = ("email", "ip", "card", "phone")
HIDDEN, SYMBOLS, PAD = 8, 131, 130
WINDOW, OVERLAP, BATCH = 256, 48, 2048
FIT_DOCS, FIT_OTHERS, FIT_WINDOWS, FIT_LENGTH, EPOCHS, SEED = 2000, 500, 6000, 96, 10, 11
LEAST_CHECKED, RESPELLED = 30, 3
FIT_BYTES = 20_000
#: How often a span at a window's edge is looked at again in a window around what was seen of it.
RECENTRED = 4

# The base patterns.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Every text with a base span matches; few others do.
_LIKELY = (r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]|[0-9]\.[0-9]++\.[0-9]++\.[0-9]"
           r"|[0-9](?:[\x20-]?[0-9]){15}|\+[0-9](?:[\x20().-]*+[0-9]){7}")

_SIGN = np.isin(np.arange(256), np.frombuffer(b"0123456789@+", np.uint8))

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        v = int(d) * (1 + n % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterable[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield 0, start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the base patterns, by kind, then start."""
    if not text:
        return []
    spans = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            spans += [(1, run.start() + m.start(), run.start() + m.end()) for m in _IP.finditer(run[0])
                      if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return spans


def symbols(text: str) -> np.ndarray:
    """A number per code point: ASCII itself, then other letters, then the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < 128, points, np.where(points < 0x2000, 128, 129)).astype(np.uint8)


def cut(row: np.ndarray, length: int = WINDOW, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows over a text and the padded windows."""
    starts = np.arange(0, max(1, len(row) - overlap), length - overlap)
    padded = np.full(int(starts[-1]) + length, PAD, np.uint8)
    padded[: len(row)] = row
    return starts, np.lib.stride_tricks.sliding_window_view(padded, length)[starts]


@dataclass
class BiLstmCrf:
    """Weights: per direction an input table (4H x symbols) and recurrence (4H x H); emissions; transitions."""

    inputs: list[np.ndarray]
    recur: list[np.ndarray]
    emit: np.ndarray      # labels x (2H + 1)
    moves: np.ndarray     # from x to
    limits: tuple[float, ...] = (np.inf,) * len(KINDS)  # per kind, the margin that an added span must exceed

    @classmethod
    def start(cls, rng: np.random.Generator, hidden: int = HIDDEN) -> BiLstmCrf:
        k = len(KINDS) + 1
        inputs = [rng.normal(0, 0.3, (4 * hidden, SYMBOLS)).astype(np.float32) for _ in range(2)]
        for x in inputs:
            x[hidden:2 * hidden] += 0.5  # forget gates, in tanh's half scale
        return cls(inputs, [rng.normal(0, 0.2, (4 * hidden, hidden)).astype(np.float32) for _ in range(2)],
                   rng.normal(0, 0.2, (k, 2 * hidden + 1)).astype(np.float32), np.zeros((k, k), np.float32))

    def run(self, windows: np.ndarray, keep: bool = False):
        """Hidden states (2H x T x B), with what the backward pass needs if ``keep``."""
        count, length = windows.shape
        hid = self.recur[0].shape[1]
        states = np.empty((2 * hid, length, count), np.float32)
        steps = np.ascontiguousarray(windows.T, np.intp)
        trace = [[], []]
        for way in (0, 1):
            h, c = np.zeros((hid, count), np.float32), np.zeros((hid, count), np.float32)
            z, y = np.empty((4 * hid, count), np.float32), np.empty((4 * hid, count), np.float32)
            for t in range(length) if way == 0 else range(length - 1, -1, -1):
                np.take(self.inputs[way], steps[t], axis=1, out=z, mode="clip")
                np.matmul(self.recur[way], h, out=y)
                z += y
                np.tanh(z, out=z)
                gate = z[:3 * hid]  # input, forget, output as sigmoids of the doubled argument
                gate *= 0.5
                gate += 0.5
                before, last = c, h
                c = z[hid:2 * hid] * c
                c += z[:hid] * z[3 * hid:]
                th = np.tanh(c)
                h = z[2 * hid:3 * hid] * th
                states[way * hid:(way + 1) * hid, t] = h
                if keep:
                    trace[way].append((t, z.copy(), before, th, last))
        return states, trace

    def emissions(self, states: np.ndarray) -> np.ndarray:
        """labels x T x B."""
        flat = states.reshape(states.shape[0], -1)
        out = self.emit[:, :-1] @ flat + self.emit[:, -1:]
        return out.reshape(-1, *states.shape[1:])

    def decode(self, windows: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, margin) spans of each window's best path."""
        scores = self.emissions(self.run(windows)[0])
        margin = scores[1:].max(axis=0) - scores[0]
        gain = max(0.0, float(self.moves.max() - self.moves[0, 0]))
        found: list[list[tuple[int, int, int, float]]] = [[] for _ in range(len(windows))]
        live = np.flatnonzero((margin + 2 * gain >= 0).any(axis=0))
        if not len(live):
            return found
        scores = scores[:, :, live]
        length = scores.shape[1]
        best, back = scores[:, 0].copy(), np.empty((length, *scores[:, 0].shape), np.int8)
        for t in range(1, length):
            through = best[:, None, :] + self.moves[:, :, None]
            back[t] = through.argmax(axis=0)
            best = through.max(axis=0) + scores[:, t]
        path = np.empty((length, len(live)), np.int8)
        path[-1] = best.argmax(axis=0)
        for t in range(length - 1, 0, -1):
            path[t - 1] = np.take_along_axis(back[t], path[t][None].astype(np.int64), axis=0)[0]
        for n in np.flatnonzero(path.any(axis=0)):
            own = path[:, n]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
            for a, b in zip(edges, edges[1:]):
                if own[a]:
                    over = scores[own[a], a:b, n] - scores[0, a:b, n]
                    found[live[n]].append((int(own[a]) - 1, int(a), int(b), float(over.mean())))
        return found

    def gradients(self, windows: np.ndarray, labels: np.ndarray):
        """Mean negative log-likelihood of the labels and its gradients, in the order of ``weights``."""
        states, trace = self.run(windows, keep=True)
        scores = self.emissions(states).astype(np.float64)
        k, length, count = scores.shape
        moves, cols = self.moves.astype(np.float64), np.arange(count)
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, length):
            alpha[:, t] = _logsum(alpha[:, None, t - 1] + moves[:, :, None], 0) + scores[:, t]
        for t in range(length - 2, -1, -1):
            beta[:, t] = _logsum(moves[:, :, None] + (scores[:, t + 1] + beta[:, t + 1])[None], 1)
        total = _logsum(alpha[:, -1], 0)
        d_scores = np.exp(alpha + beta - total)
        d_moves = np.zeros_like(moves)
        gold = scores[labels[:, 0], 0, cols]
        for t in range(1, length):
            pair = np.exp(alpha[:, None, t - 1] + moves[:, :, None] + (scores[:, t] + beta[:, t])[None] - total)
            d_moves += pair.sum(axis=2)
            np.add.at(d_moves, (labels[:, t - 1], labels[:, t]), -1)
            gold = gold + scores[labels[:, t], t, cols] + moves[labels[:, t - 1], labels[:, t]]
        for t in range(length):
            d_scores[labels[:, t], t, cols] -= 1
        d_scores = (d_scores / count).astype(np.float32)
        flat, hid = d_scores.reshape(k, -1), self.recur[0].shape[1]
        d_emit = np.concatenate([flat @ states.reshape(2 * hid, -1).T, flat.sum(axis=1, keepdims=True)], axis=1)
        d_states = (self.emit[:, :-1].T @ flat).reshape(2 * hid, length, count)
        d_inputs, d_recur = [], []
        for way in (0, 1):
            d_in, d_re = np.zeros((SYMBOLS, 4 * hid), np.float32), np.zeros_like(self.recur[way])
            dh, dc = np.zeros((hid, count), np.float32), np.zeros((hid, count), np.float32)
            for t, z, before, th, last in reversed(trace[way]):
                dh = dh + d_states[way * hid:(way + 1) * hid, t]
                i, f, o, g = (z[n * hid:(n + 1) * hid] for n in range(4))
                dc = dc + dh * o * (1 - th * th)
                dz = np.concatenate([dc * g * 2 * i * (1 - i), dc * before * 2 * f * (1 - f),
                                     dh * th * 2 * o * (1 - o), dc * i * (1 - g * g)])
                np.add.at(d_in, windows[:, t], dz.T)
                d_re += dz @ last.T
                dh, dc = self.recur[way].T @ dz, dc * f
            d_inputs.append(d_in.T)
            d_recur.append(d_re)
        return float((total - gold).mean()), [*d_inputs, *d_recur, d_emit, (d_moves / count).astype(np.float32)]

    @property
    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recur, self.emit, self.moves]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def train(windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED,
          batch: int = 64, rate: float = 0.02) -> BiLstmCrf:
    """Adam on the CRF likelihood; the last fifth sets the margin that added spans must exceed."""
    rng = np.random.default_rng(seed)
    model = BiLstmCrf.start(rng)
    held = max(1, len(windows) // 5)
    fit_, check = np.arange(len(windows) - held), np.arange(len(windows) - held, len(windows))
    first = [np.zeros_like(w) for w in model.weights]
    second = [np.zeros_like(w) for w in model.weights]
    step = 0
    for epoch in range(epochs):
        for some in np.array_split(rng.permutation(fit_), max(1, len(fit_) // batch)):
            if not len(some):
                continue
            step += 1
            _, grads = model.gradients(windows[some], labels[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for w, g, m, v in zip(model.weights, grads, first, second):
                g = g * min(1.0, 5 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (0.5 ** (epoch // 4)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    wrong = [(kind, margin) for n, spans in zip(check, model.decode(windows[check])) for kind, a, b, margin in spans
             if not (labels[n, a:b] == kind + 1).all() or (b < labels.shape[1] and labels[n, b] == kind + 1)
             or (a and labels[n, a - 1] == kind + 1)]
    model.limits = tuple(max((m for k, m in wrong if k == kind), default=0.0) for kind in range(len(KINDS)))
    return model


def respelled(kind: int, text: str, rng: np.random.Generator) -> str:
    """Personal data as it may be written so that the base pattern misses it."""
    def one_of(*some: str) -> str:
        return some[int(rng.integers(len(some)))]

    if KINDS[kind] == "email":
        name, _, host = text.partition("@")
        return name + one_of(" at ", " (at) ", "[at]", " @ ") + host.replace(".", one_of(".", " dot ", "[.]"))
    if KINDS[kind] == "ip":
        return text.replace(".", one_of("[.]", " . ", "(.)", "-"))
    digits = re.sub("[^0-9]", "", text)
    if KINDS[kind] == "card":
        return one_of(".", "/", "_", " - ").join(digits[k:k + 4] for k in range(0, len(digits), 4))
    cut_ = max(1, len(digits) - 7)
    return one_of("tel ", "00", "(+) ", "p:") + one_of("/", "-", ".").join((digits[:cut_], digits[cut_:-4], digits[-4:]))


def training_windows(texts: list[str], length: int = FIT_LENGTH, most: int = FIT_WINDOWS,
                     seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Windows around base spans, respelled ones, other digits and signs, and elsewhere; a label per character (0: outside)."""
    rng = np.random.default_rng(seed)
    windows, labels = [], []
    for text in texts:
        spans = base_spans(text)
        row, tags = symbols(text), np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            tags[a:b] = kind + 1
        near = [max(0, int(a - rng.integers(0, length - min(b - a, length) + 1))) for _, a, b in spans]
        signs = np.flatnonzero(_SIGN[row] & (tags == 0))  # digits and the like that are no personal data
        hard = rng.choice(signs, min(3, len(signs)), replace=False) if len(signs) else np.empty(0, int)
        hard = np.maximum(0, hard - rng.integers(0, length, len(hard))).tolist()
        away = rng.integers(0, max(1, len(row) - length // 2), 1).tolist()
        for kind, a, b in spans * RESPELLED:    # the same place with the span respelled, if the patterns then miss it
            new = respelled(kind, text[a:b], rng)
            before = text[max(0, a - int(rng.integers(0, max(1, length - len(new))))):a]
            line = (before + new + text[b:b + length])[:length]
            if len(before) + len(new) <= length and not any(
                    x < len(before) + len(new) and len(before) < y for _, x, y in base_spans(line)):
                w, t = np.full(length, PAD, np.uint8), np.zeros(length, np.int64)
                w[:len(line)] = symbols(line)
                for k, x, y in base_spans(line):
                    t[x:y] = k + 1
                t[len(before):len(before) + len(new)] = kind + 1
                windows.append(w)
                labels.append(t)
        for start in near + hard + away:
            w, t = np.full(length, PAD, np.uint8), np.zeros(length, np.int64)
            w[: len(row[start:start + length])] = row[start:start + length]
            t[: len(tags[start:start + length])] = tags[start:start + length]
            windows.append(w)
            labels.append(t)
    order = rng.permutation(len(windows))[:most]
    return (np.array([windows[n] for n in order], np.uint8).reshape(-1, length),
            np.array([labels[n] for n in order], np.int64).reshape(-1, length))


def fitted(docs: DataFrame) -> BiLstmCrf | None:
    """A model from a bounded sample of the distinct texts in which a pattern's signs occur.

    Copies are dropped by hash of the text before anything is counted or limited, so that they take no
    place in the sample. None if fewer than ``LEAST_CHECKED`` windows would set the margin.
    """
    short = docs.where(F.octet_length("text") <= FIT_BYTES).select("text", F.xxhash64("text").alias("h"))
    known = (short.where(F.col("text").rlike("[0-9@+]")).groupBy("h")
             .agg(F.max(F.col("text").rlike(_LIKELY)).alias("likely")))
    known = written(known, "signs")  # one narrow row per distinct text
    parts = [hash_sample(known.where(F.col("likely") == yes), "h", n, known.where(F.col("likely") == yes).count(), spare=8)
             for yes, n in ((True, FIT_DOCS), (False, FIT_OTHERS))]
    chosen = [r["h"] for part in parts for r in part.select("h").collect()]
    if not chosen:
        return None
    wanted = docs.sparkSession.createDataFrame([(h,) for h in chosen], "h long")

    def once(rows: pa.RecordBatch) -> dict:
        at = pa.array(np.unique(rows.column(0).to_numpy(), return_index=True)[1])
        return {"h": rows.column(0).take(at), "text": rows.column(1).take(at)}

    found = short.join(F.broadcast(wanted), "h", "left_semi").select("h", F.col("text").cast("string").alias("text"))
    sample = arrow_map(found, once, "h long, text string").dropDuplicates(["h"])
    texts = [r["text"] for r in sorted(sample.collect(), key=lambda r: r["h"])]
    windows, labels = training_windows(texts)
    return train(windows, labels) if labels.any() and len(windows) // 5 >= LEAST_CHECKED else None


def reconcile(base: list[Span], found: Iterable[tuple[int, int, int, float]], limit: float) -> list[Span]:
    """Base spans, and the model's spans above the limit that overlap nothing better; by kind, then start."""
    taken, added = sorted((a, b) for _, a, b in base), []
    for kind, a, b, margin in sorted(set(found), key=lambda s: (-s[3], s[1], s[2], s[0])):
        if margin > limit and all(b <= x or y <= a for x, y in taken):
            added.append((kind, a, b))
            taken.append((a, b))
    return sorted({*base, *added})


def centred(row: np.ndarray, middles: Iterable[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows with the given middles, and the padded windows."""
    starts = np.unique(np.clip(np.array(sorted(middles), np.int64) - length // 2, 0, max(0, len(row) - length)))
    windows = np.full((len(starts), length), PAD, np.uint8)
    for w, start in zip(windows, starts):
        own = row[start:start + length]
        w[:len(own)] = own
    return starts, windows


def find(texts: list[str | None], model: BiLstmCrf | None, length: int = WINDOW,
         overlap: int = OVERLAP) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, sorted(b)) for b in base]
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    rows = [symbols(t or "") for t in texts]
    edges: list[set[int]] = [set() for _ in texts]

    def flush(held: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        if not held:
            return
        windows = np.concatenate([w for _, _, w in held])
        where = [(n, int(s)) for n, starts, _ in held for s in starts]
        for at in range(0, len(windows), BATCH):
            for (n, start), spans in zip(where[at:at + BATCH], model.decode(windows[at:at + BATCH])):
                size = len(rows[n])
                for kind, a, b, margin in spans:
                    whole = (a > 0 or start == 0) and (b < length or start + length >= size)
                    if not whole:
                        edges[n].add(start + (a + b) // 2)
                    elif start + b <= size and margin > model.limits[kind]:
                        found[n].append((kind, start + a, start + b, margin))

    held, count = [], 0
    for n, row in enumerate(rows):
        if len(row):
            starts, windows = cut(row, length, overlap)
            for at in range(0, len(starts), 4 * BATCH):
                held.append((n, starts[at:at + 4 * BATCH], windows[at:at + 4 * BATCH]))
                count += len(held[-1][1])
                if count >= 4 * BATCH:
                    flush(held)
                    held, count = [], 0
    flush(held)
    for _ in range(RECENTRED):      # a part's middle leads to the span's middle
        again = [(n, *centred(rows[n], middles, length)) for n, middles in enumerate(edges) if middles]
        edges = [set() for _ in texts]
        for at in range(0, len(again), BATCH):
            flush(again[at:at + BATCH])
    return [(b, reconcile(b, f, 0.0)) for b, f in zip(base, found)]


def spans_of(docs: DataFrame, model: BiLstmCrf | None = None) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end)."""
    item = "array<struct<kind: string, start: long, end: long>>"

    def run(rows: pa.RecordBatch) -> dict:
        both = find(rows.column(1).to_pylist(), model)
        named = [[[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in side] for side in pair] for pair in both]
        return {"doc_id": rows.column(0), "base": [x for x, _ in named], "spans": [x for _, x in named]}

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, run, f"doc_id {kind}, base {item}, spans {item}")


def _listed(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def _count(column: str, kind: str):
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = spans_of(docs, fitted(docs))
    count = [_count("base", kind).alias(f"n_{kind}") for kind in KINDS]
    return rows.select("doc_id", *count, F.sha2(_listed("base"), 256).alias("base_sha256"),
                       _listed("spans").alias("spans"),
                       (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind; of overlapping spans the first, longest wins."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: spans are replaced by their kind in brackets; every document stays.

    ``n_chars`` becomes the new text's length (null for a null text); all other columns stay as they are.
    """
    model = fitted(docs)
    columns = docs.columns
    place = columns.index("text")

    def run(rows: pa.RecordBatch) -> dict:
        texts = rows.column(place).to_pylist()
        clean = [redact(t, spans) for t, (_, spans) in zip(texts, find(texts, model))]
        out = {c: rows.column(i) for i, c in enumerate(columns)} | {"text": clean}
        if "n_chars" in out:
            out["n_chars"] = [None if t is None else len(t) for t in clean]
        return out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_map(docs, run, fields)
