import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import sharding
from tests.llm.helpers import awkward, docs, save, words


def test_query_on_awkward_rows(spark, tmp_path):
    save(docs(spark), tmp_path, "documents")
    rows = sharding.op10_sharding(spark, str(tmp_path)).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in awkward()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == want
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "bytes" and 0 <= r["shard"] < 8 and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_near_equal_and_keep_equal_texts(spark):
    rows = [(n, words(n % 900, 5 + n % 60)) for n in range(2000)]
    placed = sharding.kdtree_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size, home = defaultdict(int), defaultdict(set)
    for r in placed:
        size[r["shard"]] += r["size"]
        home[rows[r["doc_id"]][1]].add(r["shard"])
    mean = sum(size.values()) / 8
    assert len(size) == 8 and all(abs(s - mean) < 0.02 * mean for s in size.values())
    assert all(len(s) == 1 for s in home.values())


def test_a_text_that_is_half_of_all_rows_is_split(spark):
    rows = [(n, "the same text " * 10 if n % 2 else words(n, 20)) for n in range(3000)]
    placed = sharding.kdtree_shards(spark.createDataFrame(rows, "doc_id long, text string"))
    size = [r[1] for r in placed.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(size) == 8 and max(size) < 1.06 * sum(size) / 8


def test_target_bytes_sets_the_number_of_leaves(spark):
    rows = [(n, words(n, 30)) for n in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    total = sum(len(t.encode()) + 1 for _, t in rows)
    placed = sharding.kdtree_shards(frame, shards=None, target_bytes=-(-total // 5), keep=["text"])
    size = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    assert sorted(size) == [0, 1, 2, 3, 4] and max(size.values()) < 1.05 * total / 5
    assert {(r["doc_id"], r["text"]) for r in placed.collect()} == set(rows)


def test_main_path_has_no_python(spark):
    placed = sharding.kdtree_shards(docs(spark))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_empty_table_and_repeated_rows(spark):
    assert sharding.kdtree_shards(docs(spark, [])).count() == 0
    same = spark.createDataFrame([(1, "x")] * 20, "doc_id long, text string")
    rows = sharding.kdtree_shards(same).collect()
    assert len({r["shard"] for r in rows}) == 1 and sorted(r["slot"] for r in rows) == list(range(20))
