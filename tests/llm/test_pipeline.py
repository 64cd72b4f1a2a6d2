import corpus_pipeline
from ledgerline.llm import packing, simhash
from tests.llm.helpers import awkward, docs, save


def test_stages_and_awkward_rows(spark, tmp_path):
    frame = docs(spark)
    save(frame, tmp_path, "documents")
    save(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "toxicity", "simhash_near_dedup", "pii", "best_fit_packing"]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # without labels only the base rules, the fingerprints and the patterns decide
    good = [r for r in awkward() if len((r[1] or "").split()) >= 10 and r[0] != 11]
    assert {r["doc_id"] for r in out} == {r[0] for r in good} - {6}
    assert len([r for r in out if r["doc_id"] == 5 and r["piece"] == 0]) == 1
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append(r["length"])
    assert max(map(sum, bins.values())) <= packing.CAPACITY
    assert simhash.MAX_BITS == 2


def test_stages_with_labels(spark, tmp_path):
    """Forests and dictionaries decide too: labelled junk and toxic texts that pass the base rules go, clean ones stay."""
    import random

    rng = random.Random(4)
    calm = [f"calm{k}" for k in range(300)]
    rude = [f"rude{k}" for k in range(12)]

    def text(kind):
        words = [rng.choice(calm) for _ in range(rng.randint(40, 90))]
        if kind == "toxic":
            words = [rng.choice(rude) if rng.random() < 0.5 else w for w in words]
        if kind == "junk":
            words = ["#$%&|<>" * rng.randint(1, 3) if rng.random() < 0.6 else w for w in words]
        return " ".join(words)

    kinds = {i: ("toxic" if i % 5 == 1 else "junk" if i % 5 == 2 else "clean") for i in range(900)}
    rows = [(i, text(kind), "en", "s", 1) for i, kind in kinds.items()]
    save(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), tmp_path, "documents")
    labels = [(i, int(kind != "junk"), int(kind == "toxic")) for i, kind in kinds.items() if i % 3]
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    stages, gone, frame = dict(corpus_pipeline.STAGES), {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name in ("quality_rules", "toxicity"):
        before = {r.doc_id for r in frame.select("doc_id").collect()}
        kept = stages[name](spark, frame, str(tmp_path))
        assert kept.columns == frame.columns
        kept.write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        gone[name] = before - {r.doc_id for r in frame.select("doc_id").collect()}
    unlabelled = {i for i in kinds if i % 3 == 0}
    for name, kind in (("quality_rules", "junk"), ("toxicity", "toxic")):
        own = {i for i, k in kinds.items() if k == kind}
        assert len(gone[name] & own & unlabelled) > 0.8 * len(own & unlabelled), name
        assert len(gone[name] - own) < 0.05 * (len(kinds) - len(own)), name
    packed = stages["best_fit_packing"](spark, frame, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kinds) - gone["quality_rules"] - gone["toxicity"]
