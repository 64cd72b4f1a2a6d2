"""Quality rules with an isolation forest on rule statistics.

Each whole text is read once and becomes a row of rule statistics (word and
symbol counts, repeated lines and word windows, letter case, ...). The base
rules reject on their own; among the rest isolation forests judge the
statistics' ratios: trees of random splits, in which unusual rows end after
few splits. There is one forest for each family of rules (``FAMILIES``), so a
rule that sets junk apart is not drowned by one that varies among good texts.
A family's score 2 ** (-mean path / c(sample)) has a threshold of its own,
calibrated on labelled rows: the lowest that at most ``max_false`` of the
accepted rows exceed, and none (1) if what exceeds it is not mostly rejected
rows. A row goes if any family's score is above its threshold.

All labelled rows that pass the base rules take part, half of them for the trees
and half for the thresholds (by the hash of the id). A tree of an isolation
forest is grown on ``SAMPLE`` rows by definition: every tree draws its own among
all rows of its half, ``JUNK_SHARE`` of them labelled as rejected, so that the
splits reach over the values that junk takes. The draws are row numbers, which
Spark looks up (rows are counted and numbered by ranges of the hash), so the
driver gets the drawn rows alone. The thresholds are exact over the whole other
half: Spark scores it, and order statistics are found by counts of the scores'
bits. Ratios do not grow with a text's length, so long clean texts are not
unusual. Texts are never shuffled, only their statistics are written, joined with
the labels and scored.

Cases: a null or word-less text has zero statistics and fails the base rules;
null ids keep their row; repeated rows get the same verdict; without usable
labels (none of a kind) the forests reject nothing; empty tables give no rows.
Input columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, table, text_key, utf8, without, written

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
TREES, SAMPLE, JUNK_SHARE, MAX_FALSE, MIN_PRECISION, SEED = 60, 256, 0.04, 0.001, 0.9, 7
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower",
          "n_digits", "n_marks", "n_lines", "n_runs")
RATIOS = ("word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "runs")

FAMILIES = {"symbols": ("symbols",), "runs": ("runs",), "case": ("upper", "marks"), "shape": ("word_length", "digits"),
            "repetition": ("dup_lines", "repeats")}

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?.,;:", np.uint8)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    keys, base = ids[:n], len(seen)
    for k in range(1, window):
        if int(keys.max()) + 1 > (1 << 62) // base:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * base + ids[k:n + k]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def statistics(text: bytes | None) -> list[int]:
    """``COUNTS`` of a UTF-8 text; words are runs without space or \\t-\\r."""
    text = text or b""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    c = np.bincount(raw, minlength=256)
    points = len(raw) - int(c[128:192].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    runs = int(((raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])
                & (raw[2:] > 32) & ((raw[2:] < 48) | (raw[2:] > 57))).sum()) if len(raw) > 2 else 0
    return [len(words), points - int(c[32] + c[9:14].sum()), int(c[_SYMBOLS].sum()),
            len(lines) - len(set(lines)), repeated_words(words), int(c[65:91].sum()), int(c[97:123].sum()),
            int(c[48:58].sum()), int(c[_MARKS].sum()), len(lines), runs]


def rule_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    carried: Sequence[Column] = ()) -> DataFrame:
    """(doc_id, *carried, *COUNTS) of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), *carried, F.col(text_column).cast("string").alias("text"))
    names = rows.columns[:-1]

    def run(batch: pa.RecordBatch) -> dict:
        stats = np.array([statistics(t) for t in utf8(batch)], np.int64)
        return {n: batch.column(i) for i, n in enumerate(names)} | {
            n: pa.array(stats[:, k]) for k, n in enumerate(COUNTS)}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return arrow_map(rows, run, f"{fields}, " + ", ".join(f"{n} long" for n in COUNTS))


def ratios(stats: np.ndarray) -> np.ndarray:
    """``RATIOS`` from rows of ``COUNTS``."""
    s = dict(zip(COUNTS, stats.T.astype(float)))
    chars, words, lines = np.maximum(s["word_chars"], 1), np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    letters = np.maximum(s["n_upper"] + s["n_lower"], 1)
    return np.column_stack([s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines,
                            s["n_repeat_words"] / words, s["n_upper"] / letters, s["n_digits"] / chars,
                            s["n_marks"] / words, s["n_runs"] / chars])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(m - 1 + 1e-12) + np.euler_gamma) * (n > 2) + (n == 2)
                    - 2 * (m - 1) / m * (n > 2))


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1: leaf), cut, index of the left child (right: next), leaf path."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    sample: int

    @classmethod
    def fit(cls, rows: np.ndarray, pick, trees: int = TREES, seed: int = SEED) -> IsolationForest:
        """``pick(rng)`` gives the row numbers of one tree's sample."""
        rng = np.random.default_rng(seed)
        feature, cut, child, path, roots, sizes = [], [], [], [], [], []

        def leaf() -> int:
            feature.append(-1), cut.append(0.0), child.append(0), path.append(0.0)
            return len(feature) - 1

        for _ in range(trees):
            own = pick(rng)
            sizes.append(len(own))
            roots.append(leaf())
            todo = [(roots[-1], own, 0)]
            limit = max(1, int(np.ceil(np.log2(max(2, len(own))))))
            while todo:
                at, some, depth = todo.pop()
                low, high = rows[some].min(0), rows[some].max(0)
                free = np.flatnonzero(high > low)
                if depth == limit or len(some) < 2 or not len(free):
                    path[at] = depth + float(average_path(len(some)))
                    continue
                f = int(rng.choice(free))
                feature[at], cut[at] = f, float(rng.uniform(low[f], high[f]))
                left = rows[some, f] <= cut[at]
                child[at] = leaf()
                leaf()
                todo += [(child[at], some[left], depth + 1), (child[at] + 1, some[~left], depth + 1)]
        return cls(np.array(feature, np.int32), np.array(cut), np.array(child, np.int32), np.array(path),
                   np.array(roots, np.int32), int(np.mean(sizes)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; higher: isolated after fewer splits."""
        total = np.zeros(len(rows))
        everyone = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root, np.int32)
            open_ = everyone
            while len(open_):
                node = at[open_]
                inner = self.feature[node] >= 0
                open_, node = open_[inner], node[inner]
                at[open_] = self.child[node] + (rows[open_, self.feature[node]] > self.cut[node])
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / max(float(average_path(self.sample)), 1e-9))


def kth_largest(scores: DataFrame, ks: dict[str, int]) -> dict[str, int]:
    """Exactly the ``ks[name]``-th largest (from 0) of each column, from counts by 16 bits at a time.

    The columns hold the bits of doubles that are not negative, which are in the doubles' order;
    at most 65,536 counts of a column reach the driver at once.
    """
    found, left = dict.fromkeys(ks, 0), dict(ks)
    for shift in (48, 32, 16, 0):
        keys = [F.struct(F.lit(n).alias("name"), F.shiftright(n, shift).alias("key")) for n in ks]
        at = F.explode(F.array(*keys)).alias("at")
        inside = reduce(or_, [(F.col("at.name") == n) & (F.shiftright("at.key", 16) == p) for n, p in found.items()])
        counts = sorted(((r["name"], r["key"], r["count"]) for r in scores.select(at).where(inside).groupBy(
            "at.name", "at.key").count().collect()), reverse=True)
        done = set()
        for name, key, count in counts:
            if name not in done:
                if left[name] < count:
                    found[name] = key
                    done.add(name)
                else:
                    left[name] -= count
    return found


def calibrate(scores: DataFrame, names: Sequence[str], max_false: float = MAX_FALSE,
              min_precision: float = MIN_PRECISION) -> dict[str, float]:
    """For each column of scores (as bits, beside ``quality``) the lowest threshold (scores above it are
    rejected) that costs few good rows; 1 if it catches little."""
    def value(bits: int) -> float:
        return float(np.int64(bits).view(np.float64))

    size = {r["quality"]: r["count"] for r in scores.groupBy("quality").count().collect()}
    allowed = int(max_false * size[1])
    floors = kth_largest(scores.where("quality = 1"), dict.fromkeys(names, allowed))
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    seen = scores.agg(*[c for n in names for c in (
        F.count_if(good & (F.col(n) > floors[n])).alias(f"good_{n}"), F.count_if(bad & (F.col(n) > floors[n])).alias(f"bad_{n}"),
        F.min(F.when(bad & (F.col(n) > floors[n]), F.col(n))).alias(f"least_{n}"))]).first()
    limits = {}
    for n in names:
        above, lost = seen[f"bad_{n}"], seen[f"good_{n}"]
        little = not above or above / size[0] < min_precision * allowed / size[1] or above < min_precision * (above + lost)
        limits[n] = 1.0 if little else (value(floors[n]) + value(seen[f"least_{n}"])) / 2
    return limits


@dataclass
class Judge:
    """A forest and a threshold for each family of rules."""

    forests: dict[str, IsolationForest]
    limits: dict[str, float]

    def verdict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest score over its threshold, and whether any threshold is exceeded."""
        most, out = np.zeros(len(rows)), np.zeros(len(rows), bool)
        for family, forest in self.forests.items():
            score = forest.score(rows[:, _columns(family)])
            most = np.maximum(most, score / self.limits[family])
            out |= score > self.limits[family]
        return most, out


def _columns(family: str) -> list[int]:
    return [RATIOS.index(r) for r in FAMILIES[family]]


def numbered(rows: DataFrame, wanted: dict[int, np.ndarray], sizes: dict[tuple[int, int], int]) -> dict[tuple[int, int], list[int]]:
    """``COUNTS`` of the rows with the ``wanted`` numbers (from 0, in the order of hash and counts) of each
    quality. ``sizes``: rows by (quality, range of the hash); only ranges that hold a wanted number are sorted."""
    spark, places = rows.sparkSession, []
    for quality, numbers in wanted.items():
        ranges = sorted(r for q, r in sizes if q == quality)
        ends = np.cumsum([sizes[quality, r] for r in ranges])
        at = np.searchsorted(ends, numbers, side="right")
        places += [(quality, ranges[k], int(n - (ends[k] - sizes[quality, ranges[k]])) + 1, int(n)) for k, n in zip(at, numbers)]
    drawn = F.broadcast(spark.createDataFrame(places, "quality int, range long, place int, number long"))
    place = F.row_number().over(Window.partitionBy("quality", "range").orderBy("h", *COUNTS)).alias("place")
    some = rows.join(F.broadcast(drawn.select("quality", "range").distinct()), ["quality", "range"])
    found = some.select("quality", "range", *COUNTS, place).join(drawn, ["quality", "range", "place"])
    return {(r["quality"], r["number"]): [r[c] for c in COUNTS] for r in found.collect()}


def fit(labelled: DataFrame, sample: int = SAMPLE, junk_share: float = JUNK_SHARE,
        max_false: float = MAX_FALSE) -> Judge | None:
    """Forests and thresholds from all rows of ``labelled_rows``; None without both kinds in both halves."""
    rows = labelled.select(F.col("quality").cast("int").alias("quality"), "h", *COUNTS,
                           F.shiftright("h", 48).alias("range"), (F.pmod("h", F.lit(2)) == 0).alias("half"))
    counts = rows.groupBy("quality", "half", "range").count().collect()      # at most 65,536 ranges
    sizes = {(r["quality"], r["range"]): r["count"] for r in counts if r["half"]}
    n = {(q, half): sum(r["count"] for r in counts if (r["quality"], r["half"]) == (q, half))
         for q in (0, 1) for half in (True, False)}
    if not all(n.values()):
        return None
    junk = max(1, round(junk_share * sample))
    draws = {}
    for k, family in enumerate(FAMILIES):
        rng = np.random.default_rng((SEED + k, 1))
        draws[family] = [[(q, int(x)) for q, size in ((1, sample - junk), (0, junk))
                          for x in rng.choice(n[q, True], min(size, n[q, True]), replace=False)] for _ in range(TREES)]
    every = sorted({d for own in draws.values() for tree in own for d in tree})
    found = numbered(rows.where("half"), {q: np.array([x for p, x in every if p == q]) for q in (0, 1)}, sizes)
    index = {d: i for i, d in enumerate(every)}
    values = ratios(np.array([found[d] for d in every], np.int64))
    judge = Judge({}, {})
    for k, family in enumerate(FAMILIES):
        trees = iter([np.array([index[d] for d in tree]) for tree in draws[family]])
        judge.forests[family] = IsolationForest.fit(values[:, _columns(family)], lambda _: next(trees), seed=SEED + k)

    def score(batch: pa.RecordBatch) -> dict:
        own = ratios(np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(COUNTS))]))
        return {"quality": batch.column(0)} | {
            f: pa.array(judge.forests[f].score(own[:, _columns(f)]).view(np.int64)) for f in FAMILIES}

    scores = written(arrow_map(rows.where("NOT half").select("quality", *COUNTS), score,
                               "quality int, " + ", ".join(f"{f} long" for f in FAMILIES)), "scores")
    judge.limits.update(calibrate(scores, list(FAMILIES), max_false))
    return judge


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows of statistics that pass the base rules and have a label, with it and the hash of their id."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")).withColumn("h", F.xxhash64("doc_id"))
    return stats.where(~base_failed()).join(known, "doc_id")


def judged(docs: DataFrame, labels: DataFrame, row_column: str | None = None) -> DataFrame:
    """(doc_id, *COUNTS, base_failed, anomaly, kept) of every row; anomaly above 1: rejected.

    ``row_column`` names another column of ``docs`` that is carried along as ``row``.
    """
    carried = [F.col(row_column).alias("row")] if row_column else []
    stats = written(rule_statistics(docs, carried=carried), "statistics")
    judge = fit(written(labelled_rows(stats, labels).select("quality", "h", *COUNTS), "labelled"))
    names = stats.columns

    def run(rows: pa.RecordBatch) -> dict:
        out = {n: rows.column(i) for i, n in enumerate(names)}
        values = np.column_stack([out[n].to_numpy() for n in COUNTS])
        score, rejected = judge.verdict(ratios(values)) if judge else (np.zeros(len(values)), np.zeros(len(values), bool))
        failed = (values[:, 0] < MIN_WORDS) | (100 * values[:, 4] > MAX_REPEAT_PERCENT * values[:, 0])
        return out | {"base_failed": pa.array(failed), "anomaly": pa.array(score), "kept": pa.array(~failed & ~rejected)}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)
    return arrow_map(stats, run, fields + ", base_failed boolean, anomaly double, kept boolean")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``documents``, thresholds from ``labels``."""
    rows = judged(table(spark, sf_dir, "documents", "doc_id", "text"),
                  table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rows.select("doc_id", *COUNTS[:5], "base_failed", "kept", "anomaly")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules or the forests reject go.

    Verdicts are matched by id and text hash, so of an id that names several
    texts only the rejected texts go. Rows without an id are judged like others.
    """
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("__text"))
    verdicts = judged(keyed, labels, row_column="__text")
    return without(docs, verdicts.where("NOT kept").select("doc_id", F.col("row").alias("__text")))
