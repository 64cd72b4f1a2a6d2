import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity
from tests.llm.helpers import awkward, docs, remainder, save, words


def sample(n=900):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        tokens, bad = words(i, 60).split(), i % 5 == 0
        for _ in range(6 if bad else 0):
            tokens[rng.randrange(len(tokens))] = rng.choice(["vilewretch", "foulscum", "rottenfool", "nastypig"])
        rows.append((i, " ".join(tokens)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_texts_are_told_apart(spark, tmp_path):
    rows, labels = sample()
    save(spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "documents")
    # held-out labels are turned around: learning from them would show
    shown = [(i, q, 1 - t if remainder(i, 4) == 2 else t) for i, q, t in labels]
    save(spark.createDataFrame(shown, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = {r["doc_id"]: r for r in toxicity.op5_toxicity(spark, str(tmp_path)).collect()}
    assert all(got[i]["held_out"] == (remainder(i, 4) == 2) for i, *_ in labels)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    held = [(t, got[i]["predicted"]) for i, _, t in labels if got[i]["held_out"]]
    assert np.mean([p for t, p in held if t]) > 0.9 and np.mean([p for t, p in held if not t]) < 0.05


def test_awkward_rows_and_no_labels(spark, tmp_path):
    frame = docs(spark)
    save(frame, tmp_path, "documents")
    save(spark.createDataFrame([(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    rows = toxicity.op5_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == len(awkward()) and all(r["score"] == 0 and r["held_out"] is not None for r in rows)
    kept = toxicity.toxicity_stage(spark, frame, str(tmp_path))
    assert kept.columns == frame.columns and kept.count() == len(awkward())


def test_model_scores_awkward_texts(spark):
    rows, labels = sample(300)
    texts = [t.encode() for _, t in rows]
    model = toxicity.fit(texts, np.array([t for *_, t in labels]), np.arange(300) % 3 == 0)
    got = toxicity.scored(docs(spark), model).collect()
    assert len(got) == len(awkward()) and all(0 <= r["score"] <= 1 for r in got)
    none = model.score([None, b"", b" \n"])
    assert none[0] == none[1] == none[2]
    assert toxicity.scored(docs(spark, []), model).count() == 0


def test_windows_cover_every_word():
    tokens = [b"%d" % n for n in range(23)]
    for n in range(24):
        seen = {t for w in toxicity.windows(tokens[:n]) for t in w.split()}
        assert seen == set(tokens[:n])


def test_phrases_of_ordinary_words_are_found():
    rng = random.Random(4)
    known = words(1, 300).split()
    phrases = [rng.sample(known, 5) for _ in range(20)]
    texts, bad = [], np.arange(1200) % 4 == 0
    for toxic in bad:
        tokens = rng.choices(known, k=60)
        for _ in range(4 * toxic):
            at = rng.randrange(55)
            tokens[at:at + 5] = rng.choice(phrases)
        texts.append(" ".join(tokens).encode())
    fold = np.array([remainder(i, 4) for i in range(1200)])
    seen = np.flatnonzero(fold != 2)
    model = toxicity.fit([texts[n] for n in seen], bad[seen].astype(int), fold[seen] == 3)
    hit = model.score([texts[n] for n in np.flatnonzero(fold == 2)]) >= 0.3
    assert hit[bad[fold == 2]].mean() > 0.75 and hit[~bad[fold == 2]].mean() < 0.1


def test_one_large_id_does_not_end_the_sample(spark, monkeypatch):
    rows, labels = sample(300)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    shown = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    order = [r["doc_id"] for r in frame.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2")
             .orderBy(F.xxhash64("doc_id")).collect()]
    large = frame.withColumn("text", F.when(F.col("doc_id").isin(order[0], order[9]), F.repeat("text", 2000))
                             .otherwise(F.col("text")))
    monkeypatch.setattr(toxicity, "FIT_BYTES", 500_000)
    monkeypatch.setattr(toxicity, "FIT_ID_BYTES", 50_000, raising=False)
    texts, toxic, calibration = toxicity.labelled_texts(large, shown)
    assert len(texts) == len(order) - 2 and toxic.any() and calibration.any()


def test_fitting_holds_few_times_the_texts(monkeypatch):
    rng = random.Random(5)
    known = words(1, 500).split()
    bad = np.arange(300) % 4 == 0
    texts = [" ".join(rng.choices(known, k=800) + ["vilewretch", "foulscum"] * int(b)).encode() for b in bad]
    monkeypatch.setattr(toxicity, "WHOLE_BYTES", (8192,))
    monkeypatch.setattr(toxicity, "MIN_SHARES", (0.01,))
    tracemalloc.start()
    try:
        assert toxicity.fit(texts, bad.astype(int), np.arange(300) % 3 == 0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4 * sum(map(len, texts))  # all words at once take eight times the texts
