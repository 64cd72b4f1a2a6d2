import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import quality
from tests.llm.helpers import awkward, docs, save, words


def slow(text):
    """The contract's base columns, plainly."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4))
    inside = {k for i in range(len(tokens) - 4) if grams[tuple(tokens[i:i + 5])] > 1 for k in range(i, i + 5)}
    return [len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(inside)]


def test_statistics_match_brute_force():
    rng = random.Random(4)
    texts = [t or "" for _, t, *_ in awkward()]
    texts += ["".join(rng.choice("ab \n\t\x0b#|é\xa0\x1c") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += [" ".join(rng.choice(["a", "b", "c"]) for _ in range(200)), " ".join(str(n % 5000) for n in range(12000))]
    for t in texts:
        assert quality.statistics(t.encode())[:5] == slow(t)


def sample(n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = i % 6 != 0
        text = words(i, 30 + i % 80)
        rows.append((i, text if good else re.sub(r" ", lambda m: rng.choice(["*** ", "$$$ ", " ### "]), text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_forest_rejects_labelled_junk_and_keeps_good_texts(spark, tmp_path):
    rows, labels = sample()
    save(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "documents")
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = {r["doc_id"]: r for r in quality.op1_quality(spark, str(tmp_path)).collect()}
    base = {i: slow(t) for i, t in rows}
    assert all([got[i][c] for c in quality.COUNTS[:5]] == b for i, b in base.items())
    assert all(got[i]["base_failed"] == (b[0] < 10 or 100 * b[4] > 20 * b[0]) for i, b in base.items())
    good = [got[i]["kept"] for i, q, _ in labels if q and not got[i]["base_failed"]]
    bad = [got[i]["kept"] for i, q, _ in labels if not q]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_paths_match_a_walk_of_single_rows():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    forest = quality.IsolationForest.fit(x, lambda r: r.choice(300, 64, replace=False), trees=20)
    far = np.vstack([x[:5], [[9, 9, 9]]])

    def path(row, root):
        at = root
        while forest.feature[at] >= 0:
            at = forest.child[at] + (row[forest.feature[at]] > forest.cut[at])
        return forest.path[at]

    want = [2 ** (-np.mean([path(r, t) for t in forest.roots]) / quality.average_path(forest.sample)) for r in far]
    assert np.allclose(forest.score(far), want) and forest.score(far)[-1] > forest.score(x).mean()


def test_awkward_rows_without_labels(spark, tmp_path):
    frame = docs(spark)
    save(frame, tmp_path, "documents")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    rows = quality.op1_quality(spark, str(tmp_path)).collect()
    assert len(rows) == len(awkward()) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    kept = quality.quality_stage(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns
    want = sorted((r["doc_id"] for r in rows if r["kept"]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == want and None in want


def test_empty_table(spark, tmp_path):
    save(docs(spark, []), tmp_path, "documents")
    save(spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    assert quality.op1_quality(spark, str(tmp_path)).count() == 0


def test_all_labelled_rows_take_part(spark):
    n = 50_000      # more than were read before
    stats = spark.range(n).select(F.col("id").alias("doc_id"), *[
        F.lit(0).cast("long").alias(c) if c != "n_words" else F.lit(50).cast("long").alias(c) for c in quality.COUNTS])
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 5 != 0).cast("int").alias("quality"))
    assert quality.labelled_rows(stats, labels).count() == n


def test_numbers_and_order_statistics_over_all_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(q), int(h), int(h) >> 48, *map(int, c)) for q, h, c in zip(
        rng.integers(0, 2, 400), rng.integers(-2 ** 63, 2 ** 63 - 1, 400), rng.integers(0, 9, (400, len(quality.COUNTS))))]
    rows += rows[:50]
    frame = spark.createDataFrame(rows, "quality int, h long, range long, " + ", ".join(f"{c} long" for c in quality.COUNTS))
    sizes = Counter((r[0], r[2]) for r in rows)
    own = {q: sorted((r[1], *r[3:]) for r in rows if r[0] == q) for q in (0, 1)}
    got = quality.numbered(frame, {q: np.arange(len(own[q])) for q in (0, 1)}, sizes)
    assert got == {(q, i): list(r[1:]) for q in (0, 1) for i, r in enumerate(own[q])}

    a, b = rng.uniform(size=500), np.repeat(rng.uniform(size=50), 10)
    bits = spark.createDataFrame([(int(x.view(np.int64)), int(y.view(np.int64))) for x, y in zip(a, b)], "a long, b long")
    for k in (0, 7, 499):
        found = quality.kth_largest(bits, {"a": k, "b": k})
        assert [np.int64(found[n]).view(np.float64) for n in "ab"] == [np.sort(a)[499 - k], np.sort(b)[499 - k]]
