"""Toxicity by compression distance between two zstandard dictionaries.

Pairs of dictionaries are trained from labelled texts. Both of a pair share a
part trained on ordinary text, so that common words cost the same with either.
The first pair adds what is trained on words that recur among toxic texts and
are rare among ordinary ones, and the reverse. The second adds what is trained
on whole windows of toxic and of ordinary text, so that phrases of ordinary
words and rare words count too; its size, or that it is left out, is chosen on
the calibration texts, each half under weights from the other. A text is cut into overlapping windows of words; a
window that needs fewer bytes with the toxic dictionary than with the ordinary
one is evidence, the difference its strength. For each pair, how many windows save 1, 2, 3,
... bytes is counted; the counts are turned into a probability by a logistic curve calibrated on
labelled texts that no dictionary has seen.

Bounded sample: at most ``FIT_TOXIC`` toxic and ``FIT_ORDINARY`` ordinary
labelled rows (by hash of the id, whole texts) reach the driver, with at most
half of ``FIT_BYTES`` of text of each kind; an id whose texts hold more than
``FIT_ID_BYTES`` is not learned from. Two thirds train the dictionaries, one third calibrates. The
share of toxic texts in which a word must recur is chosen on the calibration
texts. Rows of the held-out fold are never learned from. Everything else covers
all rows and whole texts, without a shuffle.

Cases: a null or word-less text has no window and gets the score of no
evidence; a text without white space is one window; null ids keep their row and
are not held out; repeated rows score alike; without labels of both kinds every
score is 0; empty tables give no rows. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, fold, hash_share, table, text_key, utf8, without, written

FIT_TOXIC, FIT_ORDINARY, FIT_BYTES = 3000, 6000, 48 << 20
FIT_ID_BYTES = 1 << 20
WINDOW_WORDS, STRIDE_WORDS = 6, 5
SHARED_BYTES, OWN_BYTES, LEVEL = 32768, 2048, 3
MIN_SHARES = (0.005, 0.01, 0.02, 0.04)
CONTRAST = 10
WHOLE_BYTES = (8192, 32768, 65536)
STEPS = 10
HELD_OUT, FOLDS, CALIBRATION_FOLD = 2, 4, 3
PREDICT_AT = 0.3


def windows(words: list[bytes], size: int = WINDOW_WORDS, stride: int = STRIDE_WORDS) -> list[bytes]:
    """Overlapping windows of words, each with a space at both ends."""
    return [b" " + b" ".join(words[i:i + size]) + b" "
            for i in range(0, max(1, len(words) - size + stride), stride)] if words else []


def _train(samples: list[bytes], size: int, k: int) -> bytes:
    """A dictionary's bytes; the distinct samples themselves if they are too few to train on."""
    try:
        return zstd.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstd.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes, level: int) -> zstd.ZstdCompressor:
    params = zstd.ZstdCompressionParameters.from_level(
        level, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_content_size=False,
        write_dict_id=False, min_match=4)
    content = zstd.ZstdCompressionDict(dictionary.rjust(8), dict_type=zstd.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=content, compression_params=params)


@dataclass
class Classifier:
    """The two dictionaries and the calibration."""

    pairs: list[tuple[bytes, bytes]]  # (ordinary, toxic)
    weights: np.ndarray | None = None
    level: int = LEVEL

    def savings(self, text: bytes | None, pair: tuple[bytes, bytes]) -> np.ndarray:
        """Bytes that each window saves with the toxic dictionary of a pair."""
        plain, toxic = (_compressor(d, self.level).compress for d in pair)
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows((text or b"").lower().split())], np.int64)

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        """Per pair, windows that save at least 1..STEPS bytes, as log counts and as shares of all windows."""
        rows = []
        for text in texts:
            row = []
            for pair in self.pairs:
                saved = self.savings(text, pair)
                over = np.array([(saved >= k).sum() for k in range(1, STEPS + 1)], float)
                row += [np.log1p(over), np.sqrt(over / max(1, len(saved)))]
            rows.append(np.concatenate([*row, [np.log1p(len(saved)), 1.0]]))
        return np.array(rows).reshape(len(texts), 2 * STEPS * len(self.pairs) + 2)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression (the last column, the constant, is not shrunk)."""
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _recurring(count: Counter, own: int, other: Counter, others: int, share: float) -> set[bytes]:
    """Words in at least ``share`` of the ``own`` texts and far rarer in the others; counted are texts with a word."""
    least = max(2, share * own)
    return {w for w, n in count.items()
            if n >= least and n / own >= CONTRAST * (other[w] + 1) / max(1, others)}


def fit(texts: list[bytes], toxic: np.ndarray, calibration: np.ndarray) -> Classifier | None:
    """Dictionaries from the rows outside ``calibration``, weights from those inside.

    Texts are split again wherever their words are needed: the words of all of them,
    held at once, would take many times the driver's memory that the texts take.
    """
    first = {}
    for n, t in enumerate(texts):  # copies would make their words look as if they recurred
        first.setdefault((zlib.crc32(t), len(t), int(toxic[n])), n)
    train = [n for n in first.values() if not calibration[n]]
    bad, good = [n for n in train if toxic[n] == 1], [n for n in train if toxic[n] == 0]
    rest = np.flatnonzero(calibration)
    if not bad or not good or len(set(toxic[rest].tolist())) < 2:
        return None

    def words(n: int) -> list[bytes]:
        return texts[n].lower().split()

    shared = _train([w for n in good[::2] for w in windows(words(n), 40, 40)], SHARED_BYTES, 32)
    seen_good, seen_bad = (Counter(w for n in some for w in set(words(n))) for some in (good, bad))
    y, half = toxic[rest].astype(float), np.arange(len(rest)) % 2 == 1

    def measured(pairs: list[tuple[bytes, bytes]], known: np.ndarray | None = None) -> tuple[float, np.ndarray]:
        """Loss of each half of the calibration texts under the other's weights, and the features."""
        x = Classifier(pairs[-1:]).features([texts[n] for n in rest])
        x = x if known is None else np.concatenate([known[:, :-2], x], axis=1)
        loss = 0.0
        for side in (half, ~half):
            p = 1 / (1 + np.exp(-np.clip(x[side] @ logistic(x[~side], y[~side]), -30, 30)))
            p = np.clip(p, 1e-6, 1 - 1e-6)
            loss -= float(np.sum(y[side] * np.log(p) + (1 - y[side]) * np.log(1 - p)))
        return loss, x

    best = None
    for share in MIN_SHARES:
        marks = _recurring(seen_bad, len(bad), seen_good, len(good), share)
        plain = _recurring(seen_good, len(good), seen_bad, len(bad), share)
        own = {}
        for kind, some, keep in (("toxic", bad, marks), ("ordinary", good, plain)):
            samples = [b" " + b" ".join(hit) + b" " for n in some if (hit := [w for w in words(n) if w in keep])]
            own[kind] = shared + _train(samples * max(1, 2000 // max(1, len(samples))), OWN_BYTES, 16)
        pairs = [(own["ordinary"], own["toxic"])]
        loss, x = measured(pairs)
        if best is None or loss < best[0]:
            best = loss, pairs, x
    marks, known = best[1], best[2]
    del seen_good, seen_bad  # room for training on whole texts

    def whole(some: list[int]) -> list[bytes]:
        """A dictionary of each size from the windows of one kind of texts."""
        samples = [w for n in some for w in windows(words(n))]
        return [shared + _train(samples, size, 32) for size in WHOLE_BYTES]

    for pair in zip(whole(good), whole(bad)):
        pairs = [*marks, pair]
        loss, x = measured(pairs, known)
        if loss < best[0]:
            best = loss, pairs, x
    return Classifier(best[1], logistic(best[2], y))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, labels and the calibration mask of the bounded sample; no held-out row."""
    known = (labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(fold("doc_id", FOLDS) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("h", F.xxhash64("doc_id")))
    classes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [hash_share(known.where(F.col("toxic") == k), "h", n, classes.get(k, 0)).orderBy("h", "doc_id").limit(n)
             for k, n in ((1, FIT_TOXIC), (0, FIT_ORDINARY))]
    chosen = written(parts[0].unionByName(parts[1]), "labelled")  # at most FIT_TOXIC + FIT_ORDINARY rows of 20 bytes
    found = docs.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    sizes = sorted((r["h"], r["doc_id"], r["toxic"], r["n"]) for r in found.groupBy("h", "doc_id", "toxic").agg(
        F.sum(F.octet_length("text")).alias("n")).where(F.col("n") <= FIT_ID_BYTES).collect())
    spent, kept = [0, 0], []
    for _, i, kind, n in sizes:
        spent[kind] += n
        if spent[kind] <= FIT_BYTES // 2:
            kept.append((i,))
    if not kept:
        return [], np.empty(0, int), np.empty(0, bool)
    wanted = docs.sparkSession.createDataFrame(kept, chosen.select("doc_id").schema)
    rows = found.join(F.broadcast(wanted), "doc_id", "left_semi").select(
        "h", "doc_id", F.col("text").cast("binary").alias("text"), "toxic",
        (fold("doc_id", FOLDS) == CALIBRATION_FOLD).alias("c")).orderBy("h", "doc_id", "text").toPandas()
    return [bytes(t) for t in rows["text"]], rows["toxic"].to_numpy(int), rows["c"].to_numpy(bool)


def scored(docs: DataFrame, model: Classifier | None, row_column: str | None = None) -> DataFrame:
    """(doc_id[, row], score) of every row."""
    rows = docs.select("doc_id", *([F.col(row_column).alias("row")] if row_column else []),
                       F.col("text").cast("string").alias("text"))
    names = rows.columns[:-1]

    def run(batch: pa.RecordBatch) -> dict:
        score = model.score(utf8(batch)) if model else np.zeros(batch.num_rows)
        return {n: batch.column(i) for i, n in enumerate(names)} | {"score": pa.array(score)}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return arrow_map(rows, run, f"{fields}, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(*labelled_texts(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
    return scored(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted toxic go.

    Verdicts are matched by id and text hash; only labels of documents that are
    still there are learned from.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = fit(*labelled_texts(docs.select("doc_id", "text"), labels))
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("__text"))
    verdicts = scored(keyed, model, row_column="__text")
    return without(docs, verdicts.where(F.col("score") >= PREDICT_AT).select("doc_id", F.col("row").alias("__text")))
